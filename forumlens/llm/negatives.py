"""Hard negatives of anchor vectors by angles to reference directions.

Components are whole numbers, so scores are exact inner products. Every vector stores its norm and its angles to a few
reference directions. Rows are sorted by their nearest direction and the angle to it and cut into windows. By the
triangle inequality the angle between an anchor and any row of a window lies between the gap and the sum of
their angles to each direction; cosines of these, times the norms, widened by what rounding can do, bound the scores of
the window. Only windows whose bounds overlap the scores that are looked for are scored.

Anchors meet rows as a grid of groups: one group of anchors and one group of rows make a task of bounded size, whatever
the labels. No group is a broadcast, and a task gives back the best few rows of each of its anchors only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import Scratch

SCALE = 256
#: Whole numbers are cut at this size, so that sums of products of 2,000 components fit 63 bits.
LARGEST = 1 << 26
#: Reference directions come from the rows of smallest hash, so many at most.
SAMPLE_ROWS, DIRECTIONS = 2048, 16
BLOCK_ROWS, WINDOW_ROWS = 2048, 64
#: Rows of a group: the second number at scale, fewer while that would leave cores idle. Anchors of a group.
GROUP_ROWS, GROUP_ANCHORS = (8_192, 65_536), 16_384
ANCHORS_AT_ONCE = 256
#: What rounding may do to an angle, and to a score in relation to its size.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
NO_SCORE = -(1 << 62)
SEED = 13


@dataclass
class Vectors:
    """Vectors of one length as columns: whole components, norms, angles to the directions, and who they are."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    ints: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    def __getitem__(self, at) -> Vectors:
        return Vectors(self.row[at], self.vec_id[at], self.label[at], self.ints[at], self.norm[at], self.angles[at])


# ---- angles and bounds ---------------------------------------------------------------------
def directions(ints: np.ndarray) -> np.ndarray:
    """Unit vectors far from each other among the rows, by farthest-point steps from the mean."""
    norm = np.linalg.norm(ints, axis=1)
    units = ints[norm > 0] / norm[norm > 0, None]
    if not len(units):
        return np.zeros((DIRECTIONS, ints.shape[1]))
    chosen, nearest = [], units @ units.mean(0)
    for _ in range(DIRECTIONS):
        chosen.append(units[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, units @ chosen[-1]) if len(chosen) > 1 else units @ chosen[-1]
    return np.array(chosen)


def default_directions(dims: int) -> np.ndarray:
    x = np.random.default_rng([SEED, dims]).standard_normal((DIRECTIONS, dims))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def angles_to(ints: np.ndarray, norm: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(ints @ refs.T / np.maximum(norm, 1e-300)[:, None], -1, 1))


def window_bounds(anchors: Vectors, rows: Vectors, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have with any row of each window, by anchor and window."""
    nearest, farthest = np.minimum.reduceat(rows.angles, starts), np.maximum.reduceat(rows.angles, starts)
    short, long = np.minimum.reduceat(rows.norm, starts), np.maximum.reduceat(rows.norm, starts)
    gap, wide = np.zeros((len(anchors.row), len(starts))), np.full((len(anchors.row), len(starts)), np.pi)
    for r in range(rows.angles.shape[1]):
        own = anchors.angles[:, r, None]
        np.maximum(gap, np.maximum(nearest[:, r] - own, own - farthest[:, r]), out=gap)
        np.minimum(wide, np.minimum(own + farthest[:, r], 2 * np.pi - own - nearest[:, r]), out=wide)
    most = np.cos(np.maximum(gap - ANGLE_SLACK, 0)) * anchors.norm[:, None]
    least = np.cos(np.minimum(wide + ANGLE_SLACK, np.pi)) * anchors.norm[:, None]
    slack = SCORE_SLACK * anchors.norm[:, None] * long + 1e-3
    return np.floor(np.where(least >= 0, least * short, least * long) - slack), np.ceil(np.where(most >= 0, most * long, most * short) + slack)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in double precision where no sum can leave 53 bits."""
    size = lambda x: int(max(x.max(initial=0), -x.min(initial=0)))
    if size(a) * size(b) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def search(anchors: Vectors, rows: Vectors, low: np.ndarray, high: np.ndarray, same: bool, take: int) -> pd.DataFrame:
    """The best ``take`` rows of every anchor and slot: scores from ``low`` to ``high``, of the anchor's label or not.

    ``low`` and ``high`` have one column per slot. Rows in the order of the directions prune best.
    """
    found, slots = [], low.shape[1]
    for at in range(0, len(anchors.row), ANCHORS_AT_ONCE):
        some = anchors[at : at + ANCHORS_AT_ONCE]
        lo, hi = low[at : at + ANCHORS_AT_ONCE].copy(), high[at : at + ANCHORS_AT_ONCE]
        best = np.empty((4, 0), np.int64)  # slot, score, vec_id, row
        for first in range(0, len(rows.row), GROUP_ROWS[0]):
            block = rows[first : first + GROUP_ROWS[0]]
            starts = np.arange(0, len(block.row), WINDOW_ROWS)
            least, most = window_bounds(some, block, starts)
            wanted = lo <= hi
            floor = np.where(wanted, lo, 1 << 62).min(1)[:, None]
            ceiling = np.where(wanted, hi, NO_SCORE).max(1)[:, None]
            open_ = (most >= floor) & (least <= ceiling)
            parts = [np.empty((3, 0), np.int64)]
            for w in np.flatnonzero(open_.any(0)).tolist():
                mine, inside = np.flatnonzero(open_[:, w]), slice(w * WINDOW_ROWS, (w + 1) * WINDOW_ROWS)
                s = scores(some.ints[mine], block.ints[inside])
                fits = (some.label[mine, None] == block.label[inside]) == same
                i, j = np.nonzero(fits & (s >= floor[mine]) & (s <= ceiling[mine]))
                parts.append(np.stack([mine[i], j + inside.start, s[i, j]]))
            i, j, value = np.concatenate(parts, axis=1)
            others = some.row[i] != block.row[j]
            i, j, value = i[others], j[others], value[others]
            e, k = np.nonzero((value[:, None] >= lo[i]) & (value[:, None] <= hi[i]))
            new = np.stack([i[e] * slots + k, value[e], block.vec_id[j[e]], block.row[j[e]]])
            best = _trim(np.concatenate([best, new], axis=1), take)
            full, counts = np.unique(best[0], return_counts=True)
            full = full[counts == take]
            worst = best[1][np.searchsorted(best[0], full, side="right") - 1]
            lo.reshape(-1)[full] = np.maximum(lo.reshape(-1)[full], worst)
        found.append(pd.DataFrame({
            "anchor_row": some.row[best[0] // slots], "anchor_id": some.vec_id[best[0] // slots], "slot": best[0] % slots,
            "score": best[1], "vec_id": best[2], "row": best[3],
        }))
    return pd.concat(found, ignore_index=True)


def _trim(entries: np.ndarray, take: int) -> np.ndarray:
    """The first ``take`` entries of every slot by falling score, then vec_id; in that order."""
    slot, score, vec_id, row = entries
    entries = entries[:, np.lexsort((row, vec_id, -score, slot))]
    slot = entries[0]
    return entries[:, np.arange(len(slot)) - np.searchsorted(slot, slot) < take]


# ---- tables --------------------------------------------------------------------------------
_ROW = "dims int, cell int, angle double, row long, vec_id long, label long, anchor boolean, ints binary, norm double, angles binary"
_BLOCK = "block long, n int, dims int, row binary, vec_id binary, label binary, anchor binary, ints binary, norm binary, angles binary"
_ANCHOR = "anchor_row long, anchor_id long, label long, dims int, ints binary, norm double, angles binary, least long"
_FOUND = "anchor_row long, anchor_id long, slot int, score long, vec_id long, row long"


def _unpacked(blocks: pd.DataFrame, dims: int) -> Vectors:
    column = lambda name, kind: np.frombuffer(b"".join(blocks[name]), kind)
    return Vectors(
        column("row", np.int64), column("vec_id", np.int64), column("label", np.int64), column("ints", np.int32).reshape(-1, dims) if dims else np.zeros((int(blocks["n"].sum()), 0), np.int32),
        column("norm", np.float64), column("angles", np.float64).reshape(-1, DIRECTIONS),
    )


def _anchors(rows: pd.DataFrame, dims: int) -> Vectors:
    column = lambda name, kind, width: np.frombuffer(b"".join(rows[name]), kind).reshape(len(rows), width)
    plain = lambda name, kind: rows[name].to_numpy(kind)
    return Vectors(
        plain("anchor_row", np.int64), plain("anchor_id", np.int64), plain("label", np.int64), column("ints", np.int32, dims),
        plain("norm", np.float64), column("angles", np.float64, DIRECTIONS),
    )


def _whole(values) -> np.ndarray:
    return np.clip(np.floor(SCALE * np.array(values.tolist(), np.float64).reshape(len(values), -1)), -LARGEST, LARGEST).astype(np.int32)


def _blocks(vectors: DataFrame, anchor: Column, refs: dict[int, np.ndarray], vec_id: str, embedding: str, label: str) -> DataFrame:
    """All rows that take part, in blocks, sorted by nearest direction and the angle to it."""
    rows = _taking_part(vectors, vec_id, embedding, label, anchor).withColumn("row", F.monotonically_increasing_id())

    def place(frames):
        for f in frames:
            for dims, part in f.groupby(f["v"].map(len)):
                ints = _whole(part["v"])
                norm = np.linalg.norm(ints.astype(np.float64), axis=1)
                angles = angles_to(ints, norm, refs.get(int(dims), default_directions(int(dims))))
                cell = angles.argmin(1)
                yield pd.DataFrame({
                    "dims": int(dims), "cell": cell, "angle": angles[np.arange(len(cell)), cell], "row": part["row"], "vec_id": part["vec_id"], "label": part["label"],
                    "anchor": part["anchor"], "ints": [x.tobytes() for x in ints], "norm": norm, "angles": [x.tobytes() for x in angles],
                })

    def pack(frames):
        number, kept = TaskContext.get().partitionId() << 32, None

        def out(f: pd.DataFrame, dims: int):
            nonlocal number
            number += 1
            column = lambda name, kind: f[name].to_numpy(kind).tobytes()
            return pd.DataFrame({
                "block": [number], "n": [len(f)], "dims": [dims], **{name: [column(name, np.int64)] for name in ("row", "vec_id", "label")}, "anchor": [column("anchor", bool)],
                "ints": [b"".join(f["ints"])], "norm": [column("norm", np.float64)], "angles": [b"".join(f["angles"])],
            })

        for f in frames:
            f = f if kept is None else pd.concat([kept, f], ignore_index=True)
            kept = None
            for dims, part in f.groupby("dims"):
                for i in range(0, len(part), BLOCK_ROWS):
                    piece = part.iloc[i : i + BLOCK_ROWS]
                    if len(piece) < BLOCK_ROWS and dims == f["dims"].iloc[-1]:
                        kept = piece
                    else:
                        yield out(piece, int(dims))
        if kept is not None:
            yield out(kept, int(kept["dims"].iloc[0]))

    order = ["dims", "cell", "angle", "row"]
    return rows.mapInPandas(place, _ROW).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pack, _BLOCK)


def _taking_part(vectors: DataFrame, vec_id: str, embedding: str, label: str, anchor: Column) -> DataFrame:
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))


def _own_block(blocks: DataFrame, take: int) -> DataFrame:
    """The anchors, and the score that at least ``take`` rows of an anchor's label reach in its own block."""

    def pick(frames):
        for f in frames:
            for k in range(len(f)):
                one = f.iloc[k : k + 1]
                dims = int(one["dims"].iloc[0])
                rows = _unpacked(one, dims)
                at = np.flatnonzero(np.frombuffer(one["anchor"].iloc[0], bool))
                if not len(at):
                    continue
                some = rows[at]
                everywhere = np.full((len(at), 1), NO_SCORE), np.full((len(at), 1), 1 << 62)
                best = search(some, rows, *everywhere, same=True, take=take).groupby("anchor_row")["score"].agg(["min", "size"])
                least = best["min"].where(best["size"] == take, NO_SCORE).reindex(some.row, fill_value=NO_SCORE)
                yield pd.DataFrame({
                    "anchor_row": some.row, "anchor_id": some.vec_id, "label": some.label, "dims": dims, "ints": [x.tobytes() for x in some.ints], "norm": some.norm,
                    "angles": [x.tobytes() for x in some.angles], "least": least.to_numpy(np.int64),
                })

    return blocks.mapInPandas(pick, _ANCHOR)


def _best(anchors: DataFrame, blocks: DataFrame, groups: tuple[int, int], same: bool, take: int) -> DataFrame:
    """The best ``take`` rows of each anchor and slot over all blocks, with ``rank`` from 1."""
    of_rows, of_anchors = groups

    def meet(some: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame(columns=["anchor_row", "anchor_id", "slot", "score", "vec_id", "row"], dtype=np.int64)]
        for dims, mine in some.groupby("dims"):
            theirs = there[there["dims"] == dims].sort_values("block")
            if len(theirs):
                mine = mine.sort_values("anchor_row")
                low, high = (np.array(mine[c].tolist(), np.int64).reshape(len(mine), -1) for c in ("low", "high"))
                parts.append(search(_anchors(mine, int(dims)), _unpacked(theirs, int(dims)), low, high, same, take))
        return pd.concat(parts, ignore_index=True).astype(np.int64)

    many = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    here = anchors.withColumn("ag", F.pmod(F.xxhash64("anchor_row"), F.lit(of_anchors)).cast("int")).withColumn("rg", many(of_rows))
    there = blocks.withColumn("rg", F.pmod(F.xxhash64("block"), F.lit(of_rows)).cast("int")).withColumn("ag", many(of_anchors))
    met = here.groupBy("rg", "ag").cogroup(there.groupBy("rg", "ag")).applyInPandas(meet, _FOUND)
    ranked = F.row_number().over(Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "vec_id", "row"))
    return met.withColumn("rank", ranked).where(F.col("rank") <= take)


def hard_negatives(
    vectors: DataFrame, anchor: Column | None = None, positives: int = 5, negatives: int = 5, margin: tuple[int, int] = (80, 100),
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchor`` chooses the anchors (ids divisible by 100 unless given). Components x become floor(256 x), cut at
    ``LARGEST``; a score is the inner product with the anchor, ties go to the smaller id. An anchor's positives are its
    best ``positives`` other rows of the same label; to each belong the best ``negatives`` rows of other labels whose
    score lies between margin[0] and margin[1] percent of the positive's. Rows without id, label or vector, or with a
    component that is null or not finite, take no part; vectors of different lengths never meet; a zero vector scores
    0. Repeated rows are rows of their own. Other columns are not read. Empty tables give no rows.
    """
    anchor = F.col(vec_id).cast("long") % 100 == 0 if anchor is None else anchor
    scratch = Scratch(vectors.sparkSession, "negatives")
    sample = _taking_part(vectors, vec_id, embedding, label, anchor).orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(SAMPLE_ROWS).toPandas()
    refs = {int(dims): directions(_whole(part)) for dims, part in sample["v"].groupby(sample["v"].map(len))}
    blocks = scratch.save(_blocks(vectors, anchor, refs, vec_id, embedding, label), "blocks")
    anchors = scratch.save(_own_block(blocks, positives), "anchors")
    rows, n_anchors = blocks.agg(F.sum("n")).first()[0] or 0, anchors.count()
    groups = 1 + rows // min(max(GROUP_ROWS[0], rows // 32), GROUP_ROWS[1]), 1 + n_anchors // GROUP_ANCHORS

    everywhere = anchors.withColumns({"low": F.array("least"), "high": F.array(F.lit(1 << 62))})
    near = _best(everywhere, blocks, groups, True, positives).select("anchor_row", "rank", "vec_id", "score")
    near = near.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))
    near = scratch.save(near, "positives")
    bound = lambda percent, up: lambda p: (F.ceil if up else F.floor)(p["score"] * percent / F.lit(100).cast("decimal(3,0)"))
    windows = anchors.join(near, "anchor_row").withColumns({
        "low": _filled(F.transform("near", bound(margin[0], True)), positives, 1), "high": _filled(F.transform("near", bound(margin[1], False)), positives, 0),
    })
    far = _best(windows.drop("near"), blocks, groups, False, negatives)
    chosen = F.element_at("near", F.col("slot") + 1)
    return far.join(near, "anchor_row").select(
        "anchor_id", chosen["vec_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        chosen["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )


def _filled(values: Column, n: int, value: int) -> Column:
    """Slots without a positive look for scores from 1 to 0, of which there are none."""
    values = values.cast("array<bigint>")
    return F.slice(F.concat(values, F.array_repeat(F.lit(value).cast("bigint"), n)), 1, n)
