"""Benchmark contamination: a BM25 index of test items, searched by every passage of every document.

The index is small (items x terms, its size checked) and travels to the tasks. Impacts are BM25 weights as a
share of what an item scores against its own text. A passage is a window of words; windows overlap so that
any run of words as long as an item lies in one. Search follows block-max WAND: the greatest impacts of a
passage's terms in each block of items bound its best score there, which passes over nearly all text in array
arithmetic (frequent terms, which together lift no item above half the threshold, enter as a constant); in the
blocks that stay open, items are scored exactly. All items at or above the threshold
are retrieved. What is retrieved is verified by word shingles of question and answer.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import RollingHash, runs

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach to be retrieved.
MIN_SCORE = 0.6
SHINGLE, MIN_OVERLAP = 5, 0.8
#: Blocks of items whose greatest impacts are kept.
BLOCKS = 16
#: Bytes of item text that may travel to every task; larger benchmarks are searched in several goes.
INDEX_BYTES = 16 << 20

_WORD = re.compile(r"[^\W_]+")
_FOREIGN_MARK = re.compile(r"[^\x00-\x7f\w]")
_IN_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_hashes(text: str | None, rolling: RollingHash) -> np.ndarray:
    """A hash of each of ``words_of``."""
    text = (text or "").lower()
    data = np.frombuffer((text if text.isascii() else _FOREIGN_MARK.sub(" ", text)).encode(), np.uint8)
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return rolling.between(rolling.sums(data), edges[::2], edges[1::2])


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of a test item before, and of, its last sentence, each of ``SHINGLE`` words at least where there are so many;
    an item of one sentence is all question."""
    parts = [w for s in re.split(r"(?<=[.!?])\s+|\n+", text) if (w := words_of(s))]
    words = [w for s in parts for w in s]
    if len(parts) < 2:
        return words, []
    return words[: max(SHINGLE, len(words) - len(parts[-1]))], words[-max(SHINGLE, len(parts[-1])) :]


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """Runs of ``size`` words; of fewer words, all of them."""
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@dataclass
class Index:
    """Postings by term, block maxima, and shingles to verify with."""

    items: list[int]
    hashes: np.ndarray  # of the terms, ascending
    terms: np.ndarray  # the terms in that order; the last entry stands for no term
    blocks: np.ndarray  # greatest impact of a term (row) in a block (column); the last row, of no term, is 0
    rare: np.ndarray  # the same without frequent terms
    is_rare: np.ndarray
    slack: np.ndarray  # most that frequent terms give an item of a block
    postings: tuple[np.ndarray, np.ndarray, np.ndarray]  # of a term's range: items, impacts
    window: int  # words of a passage
    question: list[set]
    answer: list[set]
    every: list[set]
    short: list[int]  # sizes of shingles of items of fewer words


def _flat(lists: list[dict[int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each list starts (and the last ends), then all keys and values."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return starts, np.array([k for x in lists for k in x], np.int64), np.array([v for x in lists for v in x.values()], float)


def _scores(lists: tuple, terms: np.ndarray, n: int) -> np.ndarray:
    """Sum of the terms' impacts on each item."""
    starts, keys, values = lists
    sizes = starts[terms + 1] - starts[terms]
    at = np.repeat(starts[terms] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    return np.bincount(keys[at], values[at], n)


@dataclass
class Statistics:
    """Of a whole benchmark: items, words in all, words of the longest item, and in how many items each term stands."""

    items: int = 0
    words: int = 0
    longest: int = 1
    frequency: Counter = field(default_factory=Counter)

    def add(self, text: str) -> None:
        words = words_of(text)
        self.items, self.words, self.longest = self.items + 1, self.words + len(words), max(self.longest, len(words))
        self.frequency.update(set(words))


def build_index(items: list[tuple[int | None, str]], whole: Statistics) -> Index:
    """The index of some items; what their scores depend on comes from the whole benchmark."""
    counts = [Counter(words_of(t)) for _, t in items]
    n, mean, df = len(items), whole.words / max(1, whole.items), whole.frequency
    terms = {w: k for k, w in enumerate(dict.fromkeys(w for c in counts for w in c))}
    postings: list[dict[int, float]] = [{} for _ in terms]
    for i, c in enumerate(counts):
        size = K1 * (1 - B + B * c.total() / mean) if mean else K1
        raw = {w: math.log(1 + (whole.items - df[w] + 0.5) / (df[w] + 0.5)) * f * (K1 + 1) / (f + size) for w, f in c.items()}
        for w, x in raw.items():
            postings[terms[w]][i] = x / sum(raw.values())
    blocks = np.zeros((len(terms) + 1, BLOCKS))
    for t, p in enumerate(postings):
        for i, x in p.items():
            blocks[t, i % BLOCKS] = max(blocks[t, i % BLOCKS], x)
    rare, slack, given = blocks.copy(), np.zeros(BLOCKS), np.zeros(n)
    for t in sorted(range(len(postings)), key=lambda t: -len(postings[t])):
        given[list(postings[t])] += list(postings[t].values())
        if given.max() > MIN_SCORE / 2:
            break
        rare[t] = 0
        slack = np.array([given[b::BLOCKS].max(initial=0) for b in range(BLOCKS)])
    parts = [question_and_answer(t or "") for _, t in items]
    hashes = np.concatenate([word_hashes(w, RollingHash()) for w in terms])
    order = np.argsort(hashes)
    return Index(
        [i for i, _ in items], hashes[order], np.append(order, len(order)), blocks, rare, rare.any(1), slack, _flat(postings), max(whole.longest, SHINGLE),
        [shingles(q) for q, _ in parts], [shingles(a) for _, a in parts], [shingles(words_of(t)) for _, t in items],
        sorted({c.total() for c in counts if c.total() < SHINGLE}),
    )


def search(index: Index, text: str | None, rolling: RollingHash, min_score: float = MIN_SCORE) -> Iterator[tuple[int, float, float, float, float]]:
    """Retrieved items of a whole text: position, best score, and shares of question, answer and whole item found near it."""
    hashes, none = word_hashes(text, rolling), len(index.hashes)
    if not len(hashes):
        return
    at = np.minimum(np.searchsorted(index.hashes, hashes), none - 1)
    ids = index.terms[np.where(index.hashes[at] == hashes, at, none)]
    # a passage is two steps of an item's length; each starts one step after the last
    step, n, n_items = index.window, len(ids), len(index.items)
    known = np.flatnonzero(index.is_rare[ids])
    starts, _ = runs(known // step)
    sums = np.zeros((-(-n // step), BLOCKS))
    if len(known):
        sums[known[starts] // step] = np.add.reduceat(index.rare[ids[known]], starts)
    bounds = sums[:-1] + sums[1:] if len(sums) > 1 else sums
    hopeful = np.flatnonzero((bounds + index.slack).max(1) >= min_score - 1e-9)
    best: dict[int, tuple[float, set]] = {}
    words = None
    for p in hopeful.tolist():
        first, last = p * step, min((p + 2) * step, n)
        terms = np.unique(ids[first:last])
        is_open = index.blocks[terms].sum(0) >= min_score - 1e-9
        if not is_open.any():
            continue
        scores = _scores(index.postings, terms[terms < none], n_items)
        for i in np.flatnonzero((scores >= min_score - 1e-9) & is_open[np.arange(n_items) % BLOCKS]).tolist():
            words = words_of(text) if words is None else words
            around = words[max(0, first - step) : last + step]
            near = shingles(around).union(*(shingles(around, m) for m in index.short))
            old = best.get(i, (0.0, set()))
            best[i] = (max(old[0], float(scores[i])), old[1] | (near & (index.question[i] | index.answer[i] | index.every[i])))
    for i in sorted(best):
        score, seen = best[i]
        share = lambda part, seen=seen: len(part & seen) / len(part) if part else 1.0
        yield i, score, share(index.question[i]), share(index.answer[i]), share(index.every[i])


def leaks(question: float, answer: float, whole: float, min_overlap: float) -> bool:
    """Question and answer both stand there, or so much of the whole item that a changed word of its answer doesn't matter."""
    return (question >= min_overlap and answer >= min_overlap) or whole >= min_overlap


def _indexes(benchmark: DataFrame, index_bytes: int) -> Iterator[Index]:
    """Indexes of whole items, each of at most ``index_bytes`` of text; one item may be larger.

    Items are read twice, one at a time: for what scores depend on, which is counted over all of them, and for the indexes.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    whole = Statistics()
    for row in items.select("text").toLocalIterator():
        if words_of(row["text"]):
            whole.add(row["text"])
    batch, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        text = row["text"] or ""
        if not words_of(text):
            continue
        if batch and size + len(text) > index_bytes:
            yield build_index(batch, whole)
            batch, size = [], 0
        batch.append((row["item_id"], text))
        size += len(text)
    if batch:
        yield build_index(batch, whole)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_overlap: float = MIN_OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap``, ``item_overlap`` of every verified leak.

    A leak is a retrieved item of whose question and of whose answer, or of the whole of which, at least ``min_overlap``
    of the shingles stand in the document. Null and empty texts and items match nothing; items without an id are
    found like others; repeated rows come back repeated; other columns are not read. An empty benchmark or table
    gives an empty result. Scores are the same for any ``index_bytes``.
    """
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, item_overlap double"
    out = None
    for index in _indexes(benchmark, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(vars(index))

        def scan(frames, shared=shared):
            index, rolling = Index(**shared.value), RollingHash()
            for f in frames:
                rows = []
                for doc_id, text in zip(f["doc_id"], f["text"], strict=True):
                    rows += [(doc_id, index.items[i], x, q, a, w) for i, x, q, a, w in search(index, text, rolling) if leaks(q, a, w, min_overlap)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "item_overlap"]).astype({"doc_id": "Int64", "item_id": "Int64"})

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(scan, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_overlap: float = MIN_OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text leaks no item. Decided row by row; nothing is joined.

    Null and empty texts stay, so do repeated rows; columns of any name come back as they were; an empty benchmark drops
    nothing. Items need no id.
    """
    for index in _indexes(benchmark, index_bytes):
        docs = docs.where(_clean(docs.sparkSession.sparkContext.broadcast(vars(index)), min_overlap)(F.col("text").cast("string")))
    return docs


def _clean(shared, min_overlap: float):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        index, rolling = Index(**shared.value), RollingHash()
        hit = lambda t: any(leaks(q, a, w, min_overlap) for _, _, q, a, w in search(index, t, rolling))
        return pd.Series([not hit(t) for t in texts], dtype=bool)

    return clean
