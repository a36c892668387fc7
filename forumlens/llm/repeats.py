"""Repeated byte strings, removed wherever they stand, by prefix-free parsing.

A rolling hash over eight bytes triggers phrase ends, so that equal text is cut alike wherever it stands. The
dictionary of phrases is counted first: a window that holds a whole phrase which occurs once in the corpus can't
repeat, and most windows end there. Equal documents are found in the same go, and one of each set stands for
all. For the windows that are left, suffixes are ordered by hash of the window instead of by its bytes: what must
be known is whether a window has an equal, which is a run of length two or more in either order, and the order
by hash needs no bytes of other documents.

Documents are packed into chunks. Each chunk sends the sorted hashes of its phrases and documents, later of its open
windows, once each, by ranges of the hash; a range answers with two bits per hash. Equal strings of a chunk are sent as
one hash and a flag, so a passage that a third of all documents share reaches a range once per chunk.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import RollingHash, Scratch, runs

LENGTH = 200
TRIGGER_BYTES, PHRASE_BYTES = 8, 64
CHUNK_BYTES = 2 << 20
HASHES_PER_RANGE = 1 << 20
#: Goes in which the windows' hashes are exchanged, each with its share of the ranges: the disk holds one at a time.
PASSES = 4

_MIX = np.uint64(0x9E3779B97F4A7C15)


class WindowHash(RollingHash):
    """The 64-bit hash, and with it a polynomial modulo a prime.

    Modulo 2^64 some texts collide under every base, such as long patterns of two blocks in Thue-Morse order. Modulo a
    prime no two texts do: different strings of n bytes agree for a share n / 2^31 of the bases.
    """

    PRIME, BITS = np.uint64(2**31 - 1), np.uint64(31)

    def __init__(self, seed: int = 1):
        super().__init__(seed)
        rng, prime = np.random.default_rng([seed, 2]), int(self.PRIME)
        base = int(rng.integers(2**16, prime - 1))
        self.letters = rng.integers(1, prime, 256, dtype=np.uint64)
        self.field = np.uint64(base), np.uint64(pow(base, -1, prime))
        self.up = self.down = np.ones(1, np.uint64)

    @classmethod
    def _folded(cls, x: np.ndarray) -> np.ndarray:
        """Congruent and, from below 2^63, not above 2^32; in place."""
        low = x & cls.PRIME
        x >>= cls.BITS
        x += low
        return x

    @classmethod
    def _powers(cls, base: np.uint64, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * (out[-1] * base % cls.PRIME) % cls.PRIME])
        return out[:n]

    def sums(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(data) >= len(self.up):
            n = max(1 << 12, len(data) * 5 // 4) + 1
            self.up, self.down = (self._powers(base, n) for base in self.field)
        totals = np.zeros(len(data) + 1, np.uint64)
        terms = self.letters[data]
        terms *= self.up[: len(data)]
        np.cumsum(self._folded(terms), out=totals[1:])
        return super().sums(data), totals

    def between(self, sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        x = self._folded(self._folded(sums[1][ends] - sums[1][starts]))
        x *= self.down[starts]
        x = self._folded(self._folded(x))
        x[x >= self.PRIME] -= self.PRIME
        x *= _MIX
        x ^= super().between(sums[0], starts, ends)
        return x


class Chunk:
    """The documents of a chunk end to end, and the windows and phrases in them."""

    def __init__(self, data: bytes, sizes: np.ndarray, length: int, rolling: WindowHash):
        self.data, self.length, self.rolling = np.frombuffer(data, np.uint8), length, rolling
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.sums = rolling.sums(self.data)
        self._parse()

    def _parse(self) -> None:
        """Whole phrases: from one trigger to the end of the next, in one document."""
        n = len(self.data) - TRIGGER_BYTES + 1
        if n <= 0:
            self.phrases = np.empty(0, np.int64), np.empty(0, np.int64)
            return
        words = np.ndarray((n,), "<u8", self.data.tobytes(), strides=(1,))
        at = np.flatnonzero(((words * _MIX) >> np.uint64(40)) % np.uint64(PHRASE_BYTES) == 0)
        home = np.searchsorted(self.ends, at, side="right")
        fits = at + TRIGGER_BYTES <= self.ends[home] if len(at) else at.astype(bool)
        at, home = at[fits], home[fits]
        same = home[1:] == home[:-1]
        self.phrases = at[:-1][same], at[1:][same] + TRIGGER_BYTES

    def parse_hashes(self) -> np.ndarray:
        """Hashes of the phrases, then of the documents, which are kept apart from phrases of the same bytes."""
        return np.concatenate([self.hashes(*self.phrases), self.hashes(self.starts, self.ends) ^ _MIX])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.rolling.between(self.sums, starts, ends)

    def settle(self, answers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that have equals, starts of open windows, and which of these stand for equal documents too.

        A window is open if it holds no phrase that occurs once and lies in no document that another stands for.
        """
        _, _, where = _sent(self.parse_hashes())
        n = len(self.phrases[0])
        repeated, owned = (x[where] for x in answers)
        first = np.zeros(len(where), bool)
        first[np.unique(where, return_index=True)[1]] = True
        copied, stands = repeated[n:], (repeated & owned & first)[n:]
        starts, ends = (x[~repeated[:n]] for x in self.phrases)
        steps = np.zeros(len(self.data) + 1, np.int32)
        low, high = np.maximum(ends - self.length, 0), starts
        fits = low <= high
        np.add.at(steps, low[fits], 1)
        np.add.at(steps, high[fits] + 1, -1)
        closed = np.cumsum(steps[:-1]) > 0
        forced = np.zeros(len(closed), bool)
        for s, e, c, f in zip(self.starts.tolist(), self.ends.tolist(), copied.tolist(), stands.tolist(), strict=True):
            closed[s if c and not f else max(s, e - self.length + 1) : e] = True
            forced[s:e] = f
        windows = np.flatnonzero(~closed)
        return copied, windows, forced[windows]


def _sent(hashes: np.ndarray, forced: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, whether each occurs more than once, and the place of every given hash."""
    names, where, n = np.unique(hashes, return_inverse=True, return_counts=True)
    many = n > 1
    if forced is not None:
        many[where[forced]] = True
    return names, many, where


def _packed(names: np.ndarray, many: np.ndarray) -> bytes:
    steps = np.diff(names, prepend=np.uint64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T  # high bytes are mostly zero, low bytes don't shrink
    return zlib.compress(np.packbits(many).tobytes() + planes.tobytes(), 1)


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(blob), np.uint8)
    k = (n + 7) // 8
    steps = np.ascontiguousarray(raw[k:].reshape(8, n).T).reshape(-1).view(np.uint64)
    return np.cumsum(steps, dtype=np.uint64), np.unpackbits(raw[:k], count=n).astype(bool)


def _edge(k: int, n_ranges: int) -> np.uint64:
    """Last hash below the ``k``-th of ranges of equal width; for the first, none is."""
    return np.uint64((k << 64) // n_ranges - 1)


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """For the hashes that chunks sent to one range: does each occur more than once in all, and is it the first?"""
    parts = [_unpacked(b, n) for b, n in zip(frame["sent"], frame["n"], strict=True)]
    names, many = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(names, kind="stable")
    starts, sizes = runs(names[order])
    repeated = np.empty(len(names), bool)
    repeated[order] = np.repeat((sizes > 1) | np.logical_or.reduceat(many[order], starts), sizes)
    owned = np.zeros(len(names), bool)
    owned[order[starts]] = True
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    bits = {k: [np.packbits(x).tobytes() for x in np.split(v, cuts)] for k, v in (("bits", repeated), ("owned", owned))}
    return pd.DataFrame({"chunk": frame["chunk"], "part": frame["part"], "n": frame["n"], **bits})


def _repeated(chunks: DataFrame, hashes: Callable[[pd.Series, WindowHash], tuple], parts: range, n_ranges: int) -> DataFrame:
    """Answers of some of the ranges, by ``chunk`` and ``part``."""

    def send(frames):
        rolling = WindowHash()
        for f in frames:
            for _, row in f.iterrows():
                every, *forced = hashes(row, rolling)
                mine = every <= _edge(parts.stop, n_ranges)
                mine &= every > _edge(parts.start, n_ranges) if parts.start else True
                names, many, _ = _sent(every[mine], *(f[mine] for f in forced))
                cuts = [0, *np.searchsorted(names, [_edge(k + 1, n_ranges) for k in parts], side="right").tolist()]
                rows = [(k, row["chunk"], b - a, _packed(names[a:b], many[a:b])) for k, a, b in zip(parts, cuts[:-1], cuts[1:], strict=True) if a < b]
                yield pd.DataFrame(rows, columns=["part", "chunk", "n", "sent"])

    sent = chunks.mapInPandas(send, "part int, chunk long, n int, sent binary")
    return sent.groupBy("part").applyInPandas(_answer, "chunk long, part int, n int, bits binary, owned binary")


def _by_chunk(answers: DataFrame) -> DataFrame:
    """``chunk`` and ``bits``: the answers to a chunk's distinct hashes in order, one after another."""
    return answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "n", "bits", "owned"))).alias("bits"))


def _flags(answers) -> tuple[np.ndarray, np.ndarray]:
    """The answers to a chunk's distinct hashes; none were sent where there are none."""
    answers = [] if answers is None else answers
    flags = lambda name: [np.unpackbits(np.frombuffer(a[name], np.uint8), count=a["n"]).astype(bool) for a in answers]
    return tuple(np.concatenate([np.empty(0, bool), *flags(name)]) for name in ("bits", "owned"))


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    def pack(frames: Iterator[pd.DataFrame]):
        number, ids, texts, size = 0, [], [], 0
        first = TaskContext.get().partitionId() << 32

        def out():
            return pd.DataFrame({"chunk": [first + number], "ids": [ids], "sizes": [[len(t) for t in texts]], "data": [zstandard.compress(b"".join(texts), 6)]})

        for f in frames:
            for doc_id, text in zip(f["doc_id"], f["text"], strict=True):
                text = text if text is not None else b""
                if ids and size + len(text) > chunk_bytes:
                    yield out()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(text)
                size += len(text)
        if ids:
            yield out()

    return docs.mapInPandas(pack, "chunk long, ids array<long>, sizes array<long>, data binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES, keep_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (and ``spans``, ``kept``) of every row.

    Every byte covered by a string of ``length`` bytes that also starts elsewhere, in the same or another
    document, is removed; strings never cross documents and are judged on the input. Equality is that of 64-bit
    hashes that hold a polynomial modulo a prime. A null text is empty; repeated rows remove each other, if long enough, and come back repeated; other
    columns are not read. A document is worked on whole, so memory must hold some fifty times the longest.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    chunks = scratch.save(_chunks(rows, chunk_bytes), "chunks")
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0

    def parsed(row, rolling: WindowHash) -> Chunk:
        return Chunk(zstandard.decompress(row["data"]), np.asarray(row["sizes"], np.int64), length, rolling)

    def open_windows(row, rolling: WindowHash) -> tuple[np.ndarray, np.ndarray]:
        chunk = parsed(row, rolling)
        _, windows, forced = chunk.settle(_flags(row["bits"]))
        return chunk.hashes(windows, windows + length), forced

    def finish(frames):
        rolling = WindowHash()
        for f in frames:
            for _, row in f.iterrows():
                chunk = parsed(row, rolling)
                copied, windows, _ = chunk.settle(_flags(row["bits"]))
                _, _, where = _sent(chunk.hashes(windows, windows + length))
                hit = windows[_flags(row["answers"])[0][where]]
                steps = np.zeros(len(chunk.data) + 1, np.int32)
                steps[hit] += 1
                steps[hit + length] -= 1
                gone = np.cumsum(steps[:-1]) > 0
                out = []
                for doc_id, s, e, c in zip(row["ids"], chunk.starts.tolist(), chunk.ends.tolist(), copied.tolist(), strict=True):
                    mine = gone[s:e] | (c and e - s >= length)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]]))).reshape(-1, 2)
                    kept = chunk.data[s:e][~mine].tobytes()
                    more = (edges.tolist(), kept) if keep_text else ()
                    out.append((doc_id, e - s, int(mine.sum()), len(edges), hashlib.sha256(kept).hexdigest(), *more))
                yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["spans", "kept"] if keep_text else [])]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans array<array<long>>, kept binary" if keep_text else "")
    n_ranges = 1 + total // PHRASE_BYTES // HASHES_PER_RANGE
    parse = scratch.save(_repeated(chunks, lambda row, rolling: (parsed(row, rolling).parse_hashes(),), range(n_ranges), n_ranges), "parse")
    told = chunks.join(_by_chunk(parse), "chunk", "left")
    per_pass = 1 + total // 8 // HASHES_PER_RANGE // PASSES
    windows = None
    for k in range(PASSES):
        scratch.drop()
        some = scratch.save(_repeated(told, open_windows, range(k * per_pass, (k + 1) * per_pass), PASSES * per_pass), f"windows{k}")
        windows = some if windows is None else windows.unionByName(some)
    scratch.drop()
    return told.join(_by_chunk(windows).withColumnRenamed("bits", "answers"), "chunk", "left").mapInPandas(finish, schema)
