"""Near-duplicate documents by SimHash: bit counts of fingerprint segments as a grid, joined within a range.

A 64-bit fingerprint is cut into 32 segments of two bits; their bit counts are a point whose Manhattan distance
to another point never exceeds the differing bits. The segments fall into three groups that each span a grid.
Of at most four differing bits, one of the first two groups has at most one, or the third has none, so a
fingerprint visits its own cell of each group and, in the first two, the cells one step up. What meets in a
cell is compared exactly. Fingerprints that agree are one node; no pair of documents is ever written.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from forumlens.llm.common import Forest, Scratch, products, runs
from forumlens.llm.components import components

MAX_DISTANCE = 4
SHINGLE = 4
SEGMENTS = 32
#: Segments of each group, and how far a fingerprint looks from its cell there: (1 + 1) + (1 + 1) + (0 + 1) > 4.
GROUPS = ((12, 1), (11, 1), (9, 0))
ROWS_PER_TASK = 200_000
NODES_PER_SALT = 4_000_000


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text; without words it is zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), 42)).astype(np.int64))
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)]
    n = len(words) - size + 1
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        m = min(n, k + (1 << 15))
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[k:m], ends[k + size - 1 : m + size - 1], strict=True)], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint).astype("int64")


def _cells(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, cell, and whether it lives there, for every cell a fingerprint visits."""
    bits = values.view(np.uint64)[:, None] >> np.arange(0, 64, 2, dtype=np.uint64)[None, :]
    counts = ((bits & np.uint64(1)) + ((bits >> np.uint64(1)) & np.uint64(1))).astype(np.int64)
    every, out, first = np.arange(len(values)), [], 0
    for group, (n, reach) in enumerate(GROUPS):
        weights = 3 ** np.arange(n, dtype=np.int64)
        own = (counts[:, first : first + n] @ weights) * len(GROUPS) + group
        out += [(every, own, np.ones(len(values), bool)), (every, own, np.zeros(len(values), bool))]
        for k in range(n if reach else 0):
            up = np.flatnonzero(counts[:, first + k] < 2)
            out.append((up, own[up] + weights[k] * len(GROUPS), np.zeros(len(up), bool)))
        first += n
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _linked(values: np.ndarray, cells: np.ndarray, lives: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of what meets in each cell: a fingerprint and the smallest of its group."""
    order = np.lexsort((~lives, cells))
    values, cells, lives = values[order], cells[order], lives[order]
    starts, lengths = runs(cells)
    living = np.add.reduceat(lives.astype(np.int64), starts) if len(starts) else starts
    names, where = np.unique(values, return_inverse=True)
    forest = Forest(len(names))
    for i, j in products(starts, living, starts + living, lengths - living):
        near = np.bitwise_count(values[i].view(np.uint64) ^ values[j].view(np.uint64)) <= distance
        forest.link(where[i[near]], where[j[near]])
    moved = np.flatnonzero(forest.root != np.arange(len(names)))
    return names[moved], names[forest.root[moved]]


def links(nodes: DataFrame, scratch: Scratch, distance: int = MAX_DISTANCE) -> DataFrame:
    """Links ``(a, b)`` that connect what lies within ``distance``; ``nodes`` has distinct fingerprints ``fp``."""
    if distance > MAX_DISTANCE:
        raise ValueError("the groups of segments are laid out for four differing bits")
    count = nodes.count()
    salts = 1 + count // NODES_PER_SALT
    tasks = 1 + count * 24 // ROWS_PER_TASK

    def visit(frames):
        for f in frames:
            for k in range(0, len(f), 20_000):
                values = f["fp"].to_numpy(np.int64)[k : k + 20_000]
                i, cells, lives = _cells(values)
                # one share of the visitors of a cell to each salt, all that live there to every salt
                salt = np.abs(values[i] % 1_000_003) % salts
                copies = [(lives, np.full(int(lives.sum()), s)) for s in range(salts)] + [(~lives, salt[~lives])]
                for mask, s in copies:
                    c = cells[mask]
                    task = (c * 31 + s) % 1_000_003 % tasks
                    yield pd.DataFrame({"task": task, "cell": c * salts + s, "fp": values[i[mask]], "lives": lives[mask]})

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = _linked(frame["fp"].to_numpy(np.int64), frame["cell"].to_numpy(np.int64), frame["lives"].to_numpy(bool), distance)
        return pd.DataFrame({"a": a, "b": b})

    visits = nodes.mapInPandas(visit, "task long, cell long, fp long, lives boolean")
    return visits.groupBy("task").applyInPandas(compare, "a long, b long")


def near_duplicates(marked: DataFrame, scratch: Scratch, distance: int = MAX_DISTANCE) -> DataFrame:
    """Component of each distinct fingerprint: ``fp``, ``component_id`` and ``n``, the documents with it.

    ``marked`` has ``doc_id`` and ``fp``; it is read several times, so pass a written table. The component is
    the smallest ``doc_id`` in it, null only where no document of it has an id.
    """
    nodes = scratch.save(marked.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "nodes")
    group = components(links(nodes.select("fp"), scratch, distance), scratch)
    placed = nodes.join(group, nodes["fp"] == group["node"], "left").select("fp", "low", "n", F.coalesce("component", "fp").alias("component"))
    placed = scratch.save(placed, "placed")
    lowest = scratch.save(placed.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    return placed.join(lowest, "component").select("fp", "component_id", "component", "n")


def simhash_groups(docs: DataFrame, distance: int = MAX_DISTANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Null and blank texts have fingerprint zero and link like any other; repeated rows come back repeated; rows
    without an id are grouped too. Other columns are not read. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprints(F.col(text).cast("binary")).alias("fp"))
    marked = scratch.save(marked, "marked")
    groups = scratch.save(near_duplicates(marked, scratch, distance), "groups")
    return marked.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
