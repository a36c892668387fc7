"""Near copies by word shingles: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 at least.

Equal sequences of words are one node. Pairs that may link come from two sides. SimHash fingerprints of the shingles, joined
within four bits by their segments' bit counts, bring together what is nearly the same. Minima of the set under
``BANDS * ROWS`` hash functions, joined in bands, bring together the rest: two sets of similarity s agree in some band with
probability 1 - (1 - s^ROWS)^BANDS, all but 3 in 10 million pairs at 0.8. Every link is decided by whole sets.

No pair of a group is written unless it is one of few per node. First a node is compared with what shares its fingerprint
and with one centre, that of its cells which meets most others; then with one other centre. A family in
whose cells several components still meet is cut into blocks, and each pair of blocks is compared inside a task, which
gives back only what connects components.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType

from forumlens.llm.common import Forest, Scratch
from forumlens.llm.components import components
from forumlens.llm.simhash import fingerprint
from forumlens.llm.simhash import links as near_fingerprints

SHINGLE, MIN_JACCARD = 5, 0.8
BANDS, ROWS = 50, 6
#: Rows of a block of a family, rows of a task, and shingles that are compared at a time.
BLOCK_ROWS, ROWS_PER_TASK, COLUMNS = 512, 2_000, 8_192
#: Bands whose visits are shuffled at a time, and shares in which pairs and blocks get their sets: the disk holds one share at a time.
BANDS_AT_ONCE, SHARES = 10, 4
#: Slots of hashed rows: what shares none with a dropped row is kept where it lies.
SLOTS = 1 << 20
SEED = 43

_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RANDOM.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(0, 2**63, BANDS, dtype=np.uint64)


def node_of(text: bytes | None) -> int:
    """Signed hash of a text's words; texts without words share one."""
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join((text or b"").lower().split()), SEED)).astype(np.int64))


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` words, ascending; of fewer words, of all of them; of none, none."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    n = max(1, len(words) - size + 1)
    return np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts[:n], ends[-n:], strict=True)], np.uint64))


def cells_of(hashes: np.ndarray) -> np.ndarray:
    """One cell of each band, for a set that is not empty."""
    low = np.full(len(_FACTORS), 2**64 - 1, np.uint64)
    for k in range(0, len(hashes), 4096):
        low = np.minimum(low, (_FACTORS[:, None] * hashes[None, k : k + 4096]).min(1))
    return ((low.reshape(BANDS, ROWS) * _MIX).sum(1, dtype=np.uint64) ^ _BAND).view(np.int64)


@F.pandas_udf(LongType())
def nodes_of(texts: pd.Series) -> pd.Series:
    return texts.map(node_of).astype("int64")


@F.pandas_udf(ArrayType(LongType()))
def shingle_sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).view(np.int64) for t in texts], dtype=object)


@F.pandas_udf(BinaryType())
def packed(sets: pd.Series) -> pd.Series:
    return pd.Series([np.asarray(s, np.int64).tobytes() for s in sets], dtype=object)


@F.pandas_udf(DoubleType())
def jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
    both = [len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(left, right, strict=True)]
    return pd.Series([n / max(1, len(a) + len(b) - n) for n, a, b in zip(both, left, right, strict=True)], dtype="float64")


def _marks(frames):
    """Fingerprint and cells of each node; a node that comes again in a batch is worked out once."""
    for f in frames:
        f = f.drop_duplicates("_node")
        for k in range(0, len(f), 1_000):
            part = f.iloc[k : k + 1_000]
            rows = [(node, fingerprint(t, SHINGLE), cells_of(s)) for node, t in zip(part["_node"], part["text"], strict=True) if len(s := shingle_set(t))]
            yield pd.DataFrame(rows, columns=["node", "fp", "cells"])


# ---- families, block by block --------------------------------------------------------------
def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of the one list shares with each of the other."""
    both = left + right
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    column = np.unique(np.concatenate(both), return_inverse=True)[1] if both else owner
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        some = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        dense = np.zeros((len(both), COLUMNS), np.float32)
        dense[owner[some], column[some] - low] = 1
        counts += dense[: len(left)] @ dense[len(left) :].T
    return counts


def _connected(frame: pd.DataFrame, min_jaccard: float) -> pd.DataFrame:
    """Links between components of the blocks of one task that have ``min_jaccard``, as many as it takes to connect them."""
    out = []
    for _, group in frame.groupby(["family", "blocks"]):
        sets = [np.frombuffer(s, np.int64) for s in group["set"]]
        sizes, right = np.array([len(s) for s in sets], np.float64), group["right"].to_numpy(bool)
        a, b = (np.arange(len(sets)),) * 2 if not right.any() else (np.flatnonzero(~right), np.flatnonzero(right))
        shared = shared_counts([sets[i] for i in a], [sets[j] for j in b]).astype(np.float64)
        near = shared >= min_jaccard * np.maximum(1, sizes[a][:, None] + sizes[b] - shared)
        names, where = np.unique(group["component"].to_numpy(np.int64), return_inverse=True)
        forest = Forest(len(names))
        i, j = np.nonzero(near)
        forest.link(where[a[i]], where[b[j]])
        moved = np.flatnonzero(forest.root != np.arange(len(names)))
        out.append(pd.DataFrame({"a": names[moved], "b": names[forest.root[moved]]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)


class Links:
    """Candidates and links of one run; ``marked`` is a written table of ``_node`` and ``text``."""

    def __init__(self, marked: DataFrame, scratch: Scratch, min_jaccard: float):
        self.binary = marked.select("_node", F.col("text").cast("binary").alias("text"))
        self.scratch, self.min_jaccard = scratch, min_jaccard

    def found(self) -> DataFrame:
        """Links ``(a, b)`` that connect what has ``min_jaccard``."""
        save, drop = self.scratch.save, self.scratch.drop
        marks = save(self.binary.mapInPandas(_marks, "node long, fp long, cells array<long>"), "marks")
        alike = save(self._by_fingerprint(marks), "alike")
        drop("fingerprints")
        crowd = self._crowd(marks)
        drop("marks")
        weights = save(self._weights(crowd), "weights")
        first = self._centre_pairs(crowd.withColumn("component", F.col("node")), weights)
        links = self._verified(alike.union(first), "stars")
        open_cells = save(self._open(crowd, links, "first"), "open1")
        drop("alike", "crowd", "placed-first")
        second = self._centre_pairs(open_cells, weights)
        links = save(links.union(self._verified(second, "others")), "both")
        open_cells = save(self._open(open_cells.select("cell", "node"), links, "second"), "open2")
        drop("open1", "placed-second", "weights")
        return links.union(self._rest(open_cells))

    def _by_fingerprint(self, marks: DataFrame) -> DataFrame:
        """One pair per node of a fingerprint, and one per link of fingerprints."""
        nodes = marks.select("node", "fp").distinct()
        first = self.scratch.save(nodes.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
        same = nodes.join(first, "fp").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
        near = near_fingerprints(first.select("fp"), self.scratch).toDF("x", "y")
        near = near.join(first.toDF("x", "a"), "x").join(first.toDF("y", "b"), "y").select("a", "b")
        return same.union(near)

    def _crowd(self, marks: DataFrame) -> DataFrame:
        """Nodes of the cells that hold more than one; bands have no cell in common, so some are shuffled at a time."""

        def some(low: int) -> DataFrame:
            visits = marks.select("node", F.explode(F.slice("cells", low + 1, BANDS_AT_ONCE)).alias("cell"))
            shared = visits.groupBy("cell").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
            shared = self.scratch.save(shared.select("cell"), f"shared{low}")
            return visits.join(shared, "cell").select("cell", "node").distinct()

        return self._in_turn(some, range(0, BANDS, BANDS_AT_ONCE), "crowd")

    def _in_turn(self, some: Callable[[int], DataFrame], shares: Iterable[int], name: str) -> DataFrame:
        """All shares of a table as one, written one after the other; what a share shuffled is let go before the next."""
        written = {f"{name}-share{k}": k for k in shares}
        parts = []
        for part, k in written.items():
            parts.append(self.scratch.save(some(k), part))
            self.scratch.drop()
        whole = self.scratch.save(reduce(DataFrame.union, parts), name)
        self.scratch.drop(*written)
        return whole

    def _weights(self, crowd: DataFrame) -> DataFrame:
        """How many nodes a node meets in all its cells."""
        sizes = self.scratch.save(crowd.groupBy("cell").agg(F.count("*").alias("n")), "sizes")
        return crowd.join(sizes, "cell").groupBy("node").agg(F.sum("n").alias("weight"))

    def _centre_pairs(self, cells: DataFrame, weights: DataFrame) -> DataFrame:
        """Each node with the heaviest of its cells' centres that lies in another component."""
        weighed = self.scratch.save(cells.join(weights, "node"), f"weighed{uuid.uuid4().hex}")
        centre = weighed.groupBy("cell").agg(F.max(F.struct("weight", "node", "component")).alias("c"))
        centre = self.scratch.save(centre.select("cell", "c"), f"centres{uuid.uuid4().hex}")
        other = weighed.join(centre, "cell").where(F.col("c.component") != F.col("component"))
        return other.groupBy("node").agg(F.max("c").alias("c")).select(F.col("node").alias("a"), F.col("c.node").alias("b"))

    def _sets(self, nodes: DataFrame, name: str) -> DataFrame:
        """The shingle sets of some distinct nodes, with their other columns; equal nodes have equal sets, so any row's will do."""
        sets = self.binary.join(nodes, "_node").select(F.col("_node").alias("node"), *nodes.columns[1:], shingle_sets("text").alias("set"))
        return self.scratch.save(sets.groupBy("node", *nodes.columns[1:]).agg(F.first("set").alias("set")), name)

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that have ``min_jaccard``. Each node ``a`` takes its set along to few centres ``b``, one share of nodes at a time."""
        sides = pairs.where("a <> b").groupBy(F.greatest("a", "b"), F.least("a", "b")).agg(F.max(F.struct("b", "a")).alias("p"))
        pairs = self.scratch.save(sides.select("p.a", "p.b"), f"{name}-pairs")
        end = lambda of, right: F.struct(F.col(of).alias("_node"), F.lit(right).alias("right"))
        ends = pairs.select(F.inline(F.array(end("a", False), end("b", True))))
        ends = ends.groupBy("_node").agg(F.bool_or(~F.col("right")).alias("is_a"), F.bool_or("right").alias("is_b"))
        sets = self._sets(self.scratch.save(ends, f"{name}-ends"), f"{name}-sets")
        self.scratch.drop()
        right = sets.where("is_b").select(F.col("node").alias("b"), F.col("set").alias("right"))

        def some(k: int) -> DataFrame:
            share = F.pmod(F.xxhash64("a", F.lit(2)), F.lit(SHARES)) == k
            left = sets.where("is_a").select(F.col("node").alias("a"), F.col("set").alias("left")).where(share)
            both = pairs.where(share).join(left, "a").join(right, "b")
            return both.where(jaccard("left", "right") >= self.min_jaccard).select("a", "b")

        links = self._in_turn(some, range(SHARES), name)
        self.scratch.drop(f"{name}-pairs", f"{name}-ends", f"{name}-sets")
        return links

    def _open(self, cells: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """Cells in which several components still meet."""
        group = self.scratch.save(components(links, Scratch(self.scratch.spark, "near-copy-groups")), f"groups-{name}")
        placed = cells.join(group, "node", "left").select("cell", "node", F.coalesce("component", "node").alias("component"))
        placed = self.scratch.save(placed, f"placed-{name}")
        mixed = placed.groupBy("cell").agg(F.min("component").alias("l"), F.max("component").alias("h")).where("l < h")
        return placed.join(mixed.select("cell"), "cell", "left_semi")

    def _rest(self, open_cells: DataFrame) -> DataFrame:
        """What connects the components of each family that open cells hold together."""
        lowest = self.scratch.save(open_cells.groupBy("cell").agg(F.min("node").alias("low")), "lowest")
        edges = open_cells.join(lowest, "cell").where("node > low").select(F.col("node").alias("a"), F.col("low").alias("b"))
        family = self.scratch.save(components(edges, Scratch(self.scratch.spark, "near-copy-families")).toDF("node", "family"), "families")
        members = self.scratch.save(open_cells.select("node", "component").distinct(), "members")
        sets = self._sets(members.select(F.col("node").alias("_node")), "open-sets")
        self.scratch.drop()
        sizes = self.scratch.save(family.groupBy("family").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("cuts")), "family-sizes")
        rows = members.join(family, "node").join(sizes, "family")
        mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("cuts")).cast("int")
        pair = lambda o: F.struct((F.least(mine, o) * 65536 + F.greatest(mine, o)).alias("blocks"), (mine > o).alias("right"))
        rows = rows.select("node", "component", "family", F.inline(F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), pair)))
        tasks = 1 + members.count() // ROWS_PER_TASK
        limit = self.min_jaccard

        def connect(frame: pd.DataFrame) -> pd.DataFrame:
            return _connected(frame, limit)

        def some(k: int) -> DataFrame:
            share = rows.where(F.pmod(F.xxhash64("family", "blocks", F.lit(2)), F.lit(SHARES)) == k).join(sets, "node")
            dealt = share.withColumn("set", packed("set")).withColumn("task", F.pmod(F.xxhash64("family", "blocks"), F.lit(tasks)))
            return dealt.groupBy("task").applyInPandas(connect, "a long, b long")

        return self._in_turn(some, range(SHARES), "rest")


def near_copy_links(marked: DataFrame, scratch: Scratch, min_jaccard: float = MIN_JACCARD) -> DataFrame:
    """Links ``(a, b)`` of nodes that connect what has ``min_jaccard``; ``marked`` is a written table of ``_node`` and ``text``.

    Null and blank texts have no links; repeated rows are one node; no other column is read; an empty table has no links.
    """
    return Links(marked, scratch, min_jaccard).found()


def keep_one_of_near_copies(docs: DataFrame, min_jaccard: float = MIN_JACCARD) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``: the smallest ``doc_id``, then first read.

    A group is all that links of ``min_jaccard`` connect. Rows without an id come last in a group; null and blank texts
    are one group. Columns of any name come back as they were; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "near-copies")
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    marked = docs.select(nodes_of(F.col("text").cast("binary")).alias("_node"), F.monotonically_increasing_id().alias("_row"), whole.alias("_whole"))
    marked = scratch.save(marked, "documents")
    doc_id, text = (F.col("_whole")[f"c{docs.columns.index(c)}"] for c in ("doc_id", "text"))
    rank = F.struct(doc_id.isNull(), doc_id, "_row")
    nodes = scratch.save(marked.groupBy(F.col("_node").alias("node")).agg(F.min(rank).alias("rank")), "nodes")
    group = scratch.save(components(near_copy_links(marked.select("_node", text.alias("text")), scratch, min_jaccard), scratch), "groups")
    kept = nodes.join(group, "node", "left").groupBy(F.coalesce("component", "node")).agg(F.min("rank")["_row"].alias("_row"))
    rows = without_rows(marked, marked.select("_row").join(scratch.save(kept.select("_row"), "kept"), "_row", "left_anti"), scratch)
    return rows.select(*[F.col("_whole")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])


def without_rows(marked: DataFrame, dropped: DataFrame, scratch: Scratch, slots: int = SLOTS) -> DataFrame:
    """The rows of ``marked`` whose ``_row`` is not in ``dropped``; the texts of most rows that stay are not shuffled.

    Dropped rows are hashed to slots, of which at most ``slots`` are broadcast. Rows that share no slot with a dropped
    one stay where they lie; the others, the dropped rows and chance hits, are decided by their own ``_row``.
    """
    slot = F.pmod(F.xxhash64("_row"), F.lit(slots)).alias("_slot")
    dropped = scratch.save(dropped.select("_row"), "dropped")
    taken = F.broadcast(scratch.save(dropped.select(slot).distinct(), "slots"))
    placed = marked.select("*", slot)
    asked = placed.join(taken, "_slot", "left_semi").join(dropped, "_row", "left_anti")
    return placed.join(taken, "_slot", "left_anti").unionByName(asked).select(*marked.columns)
