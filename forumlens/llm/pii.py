"""Personal data in texts: base patterns, and a linear-chain conditional random field over word shapes.

The field labels number-like words (those with a digit or ``@``); every other word is no personal data, so a
chain runs over neighbouring number-like words and starts and ends outside. It is trained here, by gradient
steps on the labelled table below or one that the caller gives, and decoded by Viterbi over whole batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "crf_email", "crf_ip", "crf_card", "crf_phone")
LABELS = ("o", "email", "ip", "card", "phone")

#: Small labelled table: word before, words of a chain, their labels.
LABELLED: tuple[tuple[str, str, str], ...] = (
    ("write", "34@mail7.example.com", "email"), ("to", "anna.berg@example.org,", "email"), ("mail", "info@shop.example.net.", "email"),
    ("contact", "j_doe+news@example.com!", "email"), ("reach", "max@intranet", "email"), ("mail", "ops@build-host7", "email"),
    ("from", "<kim.lee@example.co.uk>", "email"), ("address", "sales@example", "email"), ("the", "97.51.17.173", "ip"),
    ("host", "10.0.0.1.", "ip"), ("at", "192.168.14.250,", "ip"), ("server", "172.16.254.1:8080", "ip"), ("from", "127.204.92.12", "ip"),
    ("ip", "8.8.4.4", "ip"), ("ping", "203.0.113.77", "ip"), ("card", "9807915762804490", "card"), ("pay", "4417744280351547,", "card"),
    ("visa", "4111 1111 1111 1111", "card card card card"), ("number", "5500-0000-0000-0004", "card"), ("with", "7536784127813050", "card"),
    ("card", "340000000000009", "card"), ("charge", "4000 1234 5678 9017.", "card card card card"), ("call", "+1 (017) 555-7713", "phone phone phone"),
    ("phone", "+44 20 7946 0958", "phone phone phone phone"), ("dial", "+49-30-901820", "phone"), ("tel", "(030) 555-0142", "phone phone"),
    ("call", "555-867-5309", "phone"), ("fax", "(212) 555-0187,", "phone phone"), ("ring", "+33 1 23 45 67 89", "phone phone phone phone phone phone"),
    ("mobile", "0171-5550199", "phone"), ("version", "3.", "o"), ("nc", "4.0.", "o"), ("license", "2.0.", "o"), ("in", "1999", "o"), ("page", "12", "o"),
    ("chapter", "3.2.1", "o"), ("the", "21st", "o"), ("about", "15,000", "o"), ("order", "1048576", "o"), ("price", "19.99", "o"), ("on", "2024-05-17", "o o"),
    ("at", "12:30", "o"), ("version", "10.4.2", "o"), ("top", "100", "o"), ("covid-19", "2020/21", "o"), ("is", "@", "o"), ("follow", "@someone", "o"),
    ("token", '"04dbebab91ab85687d33eeaaf9ac699e1188f962"', "o"), ("id", "a1b2c3d4e5", "o"), ("and", "3 4 5", "o o o"), ("sum", "1 2", "o o"),
    ("between", "10 20.", "o o"), ("room", "b12", "o"), ("isbn", "978-3-16-148410-0", "o"), ("key", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "o"),
    ("years", "1914-1918", "o"), ("score", "3-2", "o"), ("ratio", "1:20000", "o"), ("step", "2.)", "o"), ("a", "100%", "o"),
)
STEPS, RATE, RIDGE = 250, 0.5, 0.02

_AROUND = ".,;:!?\"'<>[]{}#$%&*|"
_WORD = re.compile(r"\S+")
_NUMBER_LIKE = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_MAILBOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match that fails at the first digit of a run of digits fails at every other
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


# ---- base patterns -------------------------------------------------------------------------
def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost matches of ``mailbox@domain``, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        while domain and start > done and text[start - 1] in _MAILBOX:
            start -= 1
        if start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches, by start, then kind."""
    if not _NUMBER_LIKE.search(text):
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


# ---- the field -----------------------------------------------------------------------------
def shape(word: str) -> str:
    """Letters as x and X, digits as d, anything but plain characters as u."""
    return "".join("d" if c in "0123456789" else ("x" if c.islower() else "X") if c.isascii() and c.isalpha() else c if c.isascii() else "u" for c in word)


def word_features(word: str, before: str) -> list[str]:
    core = word.strip(_AROUND)
    form = shape(core)
    short = re.sub(r"(.)\1+", r"\1+", form)
    digits = form.count("d")
    return [
        "bias", f"form={short}", f"digits={min(digits, 20)}", f"share={4 * digits // max(1, len(core))}", f"at={core.find('@') > 0}",
        f"dots={min(4, core.count('.'))}", f"dashes={min(3, core.count('-'))}", f"plus={core[:1] == '+'}", f"round={'(' in core}",
        f"before={before.lower()}", f"long={form if len(form) < 20 else len(form)}",
    ]


class Field:
    """Weights of a trained field: one vector of label scores per feature, and label transitions."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def scores(self, words: list[str], before: list[str]) -> np.ndarray:
        rows = [[self.names[f] for f in word_features(w, b) if f in self.names] for w, b in zip(words, before, strict=True)]
        return np.array([self.emit[r].sum(0) for r in rows]).reshape(-1, len(LABELS))


def decode(emissions: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best labels of many chains laid end to end; all chains advance one word at a time."""
    starts = np.cumsum(lengths) - lengths
    best, back = np.zeros_like(emissions), np.zeros(emissions.shape, np.int64)
    best[starts] = move[0] + emissions[starts]
    for t in range(1, int(lengths.max(initial=0))):
        at = starts[lengths > t] + t
        options = best[at - 1][:, :, None] + move[None]
        back[at] = options.argmax(1)
        best[at] = options.max(1) + emissions[at]
    labels = np.zeros(len(emissions), np.int64)
    last = starts + lengths - 1
    labels[last] = (best[last] + move[:, 0]).argmax(1)
    for t in range(int(lengths.max(initial=0)) - 1, 0, -1):
        at = starts[lengths > t] + t
        labels[at - 1] = back[at, labels[at]]
    return labels


def train_field(table: Iterable[tuple[str, str, str]] = LABELLED, steps: int = STEPS) -> Field:
    """Fit a field to labelled chains by adaptive gradient steps on the penalised log-likelihood.

    The table is small by contract: it is fitted on the driver, chain by chain, with forward and backward sums.
    """
    chains = []
    for before, words, labels in table:
        words = words.split()
        tags = (labels.split() + ["o"] * len(words))[: len(words)]
        chains.append((words, [before, *words[:-1]], np.array([LABELS.index(x) for x in tags])))
    features = [[word_features(w, b) for w, b in zip(ws, bs, strict=True)] for ws, bs, _ in chains]
    names = {f: k for k, f in enumerate(sorted({f for c in features for w in c for f in w}))}
    rows = [[np.array([names[f] for f in w]) for w in c] for c in features]
    emit, move = np.zeros((len(names), len(LABELS))), np.zeros((len(LABELS), len(LABELS)))
    seen_e, seen_m = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    log_sum = lambda x, axis: np.log(np.exp(x - x.max(axis, keepdims=True)).sum(axis)) + x.max(axis)
    for _ in range(steps):
        grad_e, grad_m = -RIDGE * emit, -RIDGE * move
        for (_, _, y), idx in zip(chains, rows, strict=True):
            score = np.array([emit[i].sum(0) for i in idx])
            n = len(y)
            forward, backward = np.zeros((n, len(LABELS))), np.zeros((n, len(LABELS)))
            forward[0] = move[0] + score[0]
            for t in range(1, n):
                forward[t] = log_sum(forward[t - 1][:, None] + move, 0) + score[t]
            backward[-1] = move[:, 0]
            for t in range(n - 2, -1, -1):
                backward[t] = log_sum(move + score[t + 1] + backward[t + 1], 1)
            total = log_sum(forward[-1] + backward[-1], 0)
            here = np.exp(forward + backward - total)
            for t, i in enumerate(idx):
                grad_e[i] -= here[t]
                grad_e[i, y[t]] += 1
            grad_m[0] -= here[0]
            grad_m[0, y[0]] += 1
            grad_m[:, 0] -= here[-1]
            grad_m[y[-1], 0] += 1
            for t in range(1, n):
                grad_m -= np.exp(forward[t - 1][:, None] + move + score[t] + backward[t] - total)
                grad_m[y[t - 1], y[t]] += 1
        seen_e += grad_e**2
        seen_m += grad_m**2
        emit = emit + RATE * grad_e / np.sqrt(seen_e)
        move = move + RATE * grad_m / np.sqrt(seen_m)
    return Field(names, emit, move)


def _covered(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches that sorted spans cover, apart from each other."""
    out: list[tuple[int, int]] = []
    for start, _, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def find_spans(texts: list[str | None], field: Field) -> list[list[tuple[int, int, int]]]:
    """Base spans of each whole text and what the field adds beside them: (start, kind, end), sorted."""
    out = [base_spans(t or "") for t in texts]
    words, before, places, lengths = [], [], [], []
    for k, text in enumerate(texts):
        if not text or not _NUMBER_LIKE.search(text):
            continue
        last, chained = "", False
        for m in _WORD.finditer(text):
            word = m[0]
            special = bool(_NUMBER_LIKE.search(word))
            if special:
                words.append(word)
                before.append(last)
                places.append((k, m.start(), m.end()))
                if chained:
                    lengths[-1] += 1
                else:
                    lengths.append(1)
            last, chained = word, special
    if not words:
        return out
    labels = decode(field.scores(words, before), np.array(lengths), field.move)
    open_span: tuple[int, int, int, int] | None = None  # text, start, label, end
    added = []
    covered = [_covered(x) for x in out]
    passed = [0] * len(out)
    for (k, start, end), label, first in zip(places, labels.tolist(), np.isin(np.arange(len(words)), np.cumsum(lengths) - lengths), strict=True):
        while passed[k] < len(covered[k]) and covered[k][passed[k]][1] <= start:
            passed[k] += 1
        if passed[k] < len(covered[k]) and covered[k][passed[k]][0] < end:
            label = 0  # a base span has this word; the field's spans end before it and start anew after it
        core = texts[k][start:end]
        start, end = start + len(core) - len(core.lstrip(_AROUND)), end - len(core) + len(core.rstrip(_AROUND))
        if open_span and not first and open_span[2] == label:
            open_span = (*open_span[:3], end)
            continue
        added += [open_span] if open_span else []
        open_span = (k, start, label, end) if label and start < end else None
    added += [open_span] if open_span else []
    for k, start, label, end in added:
        out[k].append((start, label + 3, end))
    return [sorted(x) for x in out]


# ---- tables --------------------------------------------------------------------------------
def find_pii(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id`` and ``found``, an array of (start, kind, end) by start, then kind, for every row of ``docs``.

    ``kind`` is an index of ``KINDS``; positions are code points, ends exclusive. Spans of the field never overlap
    base spans. A null or empty text has none; repeated rows come back repeated; other columns are not read.
    """

    @F.pandas_udf("array<struct<start:int,kind:int,end:int>>")
    def find(texts: pd.Series) -> pd.Series:
        rows = find_spans([t if isinstance(t, str) else None for t in texts], field)
        return pd.Series([[{"start": s, "kind": k, "end": e} for s, k, e in r] for r in rows], dtype=object)

    return docs.select("doc_id", find(F.col("text").cast("string")).alias("found"))


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each span, or chain of overlapping spans, replaced by the kind of its first."""
    if not spans:
        return text
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].removeprefix('crf_').upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_pii(docs: DataFrame, field: Field) -> DataFrame:
    """All rows and columns of ``docs`` with personal data in ``text`` replaced by tags."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        every = [t if isinstance(t, str) else None for t in texts]
        return pd.Series([redact(t, s) for t, s in zip(every, find_spans(every, field), strict=True)], dtype=object)

    return docs.withColumn("text", clean(F.col("text").cast("string")))
