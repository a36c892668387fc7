"""Periodic runs of words: stretches that repeat a period of q words four times or more, found and collapsed.

The words of a text are appended one by one to a suffix automaton, whose links form a tree: the states of all
suffixes of a prefix are one path to the root. Each state remembers where its strings ended last. Appending a word
visits its path (the access of a link-cut tree): the path falls into segments of one earlier end e each, and is
recoloured as a whole with the new end i. A segment whose strings have lengths (l, L] with l < i - e <= L says that
the last i - e words stood directly before as well, and nowhere in between: a square of primitive period i - e ends
at i. Squares of one period that end at consecutive words are one run, whose bounds follow without comparing words.

The automaton is built over zones only. A run of period q has more than 3q - 3 consecutive word triples that stood at
most q words before; stretches of triples too short for their distances are ruled out first, by sorting. No run
is lost by that, and what the zones hold is found by the automaton alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A run counts from this many words and this many periods on.
LEAST_WORDS, LEAST_PERIODS = 6, 4

_LISTS = ("starts", "lengths", "periods")
FOUND = T.StructType([*(T.StructField(name, T.ArrayType(T.LongType())) for name in _LISTS), T.StructField("kept", T.BinaryType())])


# ---- the automaton and its tree ------------------------------------------------------------
def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Lengths and links of a suffix automaton's states, and the state of each prefix; state 0 is the empty string."""
    steps: list[dict[int, int]] = [{}]
    length, link, ends = [0], [-1], []
    last = 0
    for word in words:
        state, at = len(steps), last
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        while at >= 0 and word not in steps[at]:
            steps[at][word] = state
            at = link[at]
        if at >= 0:
            found = steps[at][word]
            if length[found] != length[at] + 1:
                split = len(steps)
                steps.append(steps[found].copy())
                length.append(length[at] + 1)
                link.append(link[found])
                link[found] = split
                while at >= 0 and steps[at].get(word) == found:
                    steps[at][word] = split
                    at = link[at]
                found = split
            link[state] = found
        ends.append(state)
        last = state
    return length, link, ends


class Paths:
    """A tree cut into paths of one colour each, every path a splay tree ordered by depth (a link-cut tree).

    Node 0 stands for no node. A path's colour is kept at the root of its splay tree; 0 is uncoloured.
    """

    def __init__(self, parents: list[int]):
        self.up = parents
        self.upper, self.lower, self.colour = ([0] * len(parents) for _ in range(3))

    def _lift(self, x: int) -> None:
        """Make ``x`` the root of its splay tree, which takes the path's colour along."""
        up, upper, lower, colour = self.up, self.upper, self.lower, self.colour

        def turn(x: int) -> None:
            y = up[x]
            z = up[y]
            if upper[y] == x:
                upper[y] = moved = lower[x]
                lower[x] = y
            else:
                lower[y] = moved = upper[x]
                upper[x] = y
            if moved:
                up[moved] = y
            if z and upper[z] == y:
                upper[z] = x
            elif z and lower[z] == y:
                lower[z] = x
            else:
                colour[x] = colour[y]
            up[y], up[x] = x, z

        y = up[x]
        while y and (upper[y] == x or lower[y] == x):
            z = up[y]
            if z and (upper[z] == y or lower[z] == y):
                turn(y if (upper[z] == y) == (upper[y] == x) else x)
            turn(x)
            y = up[x]

    def recolour(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Give the path from ``node`` to the root one colour; its segments before, from below: colour, lowest node."""
        segments, below, x = [], 0, node
        while x:
            self._lift(x)
            segments.append((self.colour[x], x))
            left = self.lower[x]
            if left:  # what hangs below leaves the path and keeps its colour
                self.colour[left] = self.colour[x]
            self.lower[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return segments


def primitive_squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(end, period) of every square of primitive period, by end; ends count from 1."""
    length, link, ends = automaton(words)
    paths = Paths([max(p, 0) for p in link])
    for end, state in enumerate(ends, 1):
        segments = paths.recolour(state, end)
        for k, (before, lowest) in enumerate(segments):
            period = end - before
            if before and period <= length[lowest] and (k + 1 == len(segments) or period > length[segments[k + 1][1]]):
                yield end, period


def runs_in(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of two periods or more; periods are smallest ones."""
    found, first, last = [], {}, {}

    def close(period: int) -> None:
        start = first[period] - 2 * period
        found.append((start, last[period] - start, period))

    for end, period in primitive_squares(words):
        if last.get(period) != end - 1:
            if period in last:
                close(period)
            first[period] = end
        last[period] = end
    for period in last:
        close(period)
    return sorted(found)


# ---- texts ---------------------------------------------------------------------------------
def zones(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches outside of which no run of ``LEAST_PERIODS`` periods and ``LEAST_WORDS`` words has a word."""
    n = len(codes) - 2
    if n < LEAST_WORDS - 2:
        return []
    base = int(codes.max()) + 1
    triples = codes[:-2] * base + codes[1:-1]
    if base > 1 << 20:  # else three codes fit 63 bits
        triples = np.unique(triples, return_inverse=True)[1].astype(np.int64)
    triples = triples * base + codes[2:]
    order = np.argsort(triples, kind="stable")
    same = triples[order[1:]] == triples[order[:-1]]
    back = np.full(n, n + 1)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    live = back <= n
    while True:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], live.astype(np.int8), [0]])))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        widest = (sizes + 2) // 3
        after = np.zeros(n, bool)
        at = np.flatnonzero(live)
        after[at] = (back[at] <= np.repeat(widest, sizes)) & np.repeat(sizes >= 3, sizes)
        if len(at) == after.sum():
            break
        live = after
    out: list[tuple[int, int]] = []
    for start, size, wide in zip(starts.tolist(), sizes.tolist(), widest.tolist(), strict=True):
        low, high = max(0, start - wide), min(len(codes), start + size + 2)
        if out and low <= out[-1][1]:
            out[-1] = min(low, out[-1][0]), max(high, out[-1][1])
            while len(out) > 1 and out[-1][0] <= out[-2][1]:
                low, high = out.pop()
                out[-1] = min(low, out[-1][0]), max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def text_runs(text: bytes) -> tuple[list[tuple[int, int, int]], bytes]:
    """The runs of a text's words, and its words without those that a run repeats, joined by one space."""
    words = text.split()  # of bytes: at the six ASCII blanks only
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(code.__getitem__, words), np.int64, len(words)) if words else np.empty(0, np.int64)
    found = []
    for low, high in zones(codes):
        some = runs_in(codes[low:high].tolist())
        found += [(low + s, n, q) for s, n, q in some if n >= max(LEAST_WORDS, LEAST_PERIODS * q)]
    if found:
        steps = np.zeros(len(words) + 1, np.int64)
        for s, n, q in found:
            steps[s + q] += 1
            steps[s + n] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
    return sorted(found, key=lambda r: (r[0], r[2])), b" ".join(words)


@F.pandas_udf(FOUND)
def _found(texts: pd.Series) -> pd.DataFrame:
    rows = [text_runs(t or b"") for t in texts]
    lists = {name: [[r[k] for r in found] for found, _ in rows] for k, name in enumerate(_LISTS)}
    return pd.DataFrame({**lists, "kept": [kept for _, kept in rows]})


def periodic_runs(text: Column) -> Column:
    """``starts``, ``lengths``, ``periods`` (by start, then period) and ``kept`` bytes of a text, as a struct.

    Words stand between the six ASCII blanks and count from 0. A run is a stretch with smallest period q of at
    least ``LEAST_PERIODS`` q and ``LEAST_WORDS`` words that no neighbouring word extends. ``kept`` joins by one
    space the words that no run holds after its first q. A null, empty or blank text has no runs and keeps
    nothing; repeated rows are alike; no other column is read, so none can clash. A text is worked on whole, in
    time near linear in its words; a word inside of a zone takes about 1 kB of memory, any other about 200 bytes.
    """
    return _found(text.cast("binary"))


def as_runs(found: Column) -> Column:
    """The struct of :func:`periodic_runs` as an array of structs ``start``, ``length``, ``period``."""
    zipped = F.arrays_zip(found["starts"], found["lengths"], found["periods"])
    return zipped.cast("array<struct<start:bigint,length:bigint,period:bigint>>")
