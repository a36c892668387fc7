"""Non-negative matrix factorisation of a distributed sparse matrix, V ~ W H.

Frobenius loss, coordinate descent by columns (HALS, Cichocki & Phan 2009), NNDSVD start
(Boutsidis & Gallopoulos 2008). W has a row per document and never leaves the executors; H has at
most a thousand columns and lives on the driver.

Given the sequence of H, each row of W follows from its own row of V, so the fitted model computes W
for any row by itself, without a join. An iteration is one pass over the blocks of V that returns only
the sums W'V and W'W. To keep the passes short, W is written out every few iterations, by the same
pass, as a table in the shared folder, and the more often the larger V is; V is written once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.session import delete_written, spread_small_input, write_and_read

V_SCHEMA = "block bigint, starts binary, terms binary, weights binary"
#: A block's W, or what a task has summed up; the other columns are null.
W_SCHEMA = "block bigint, w binary, part int, packed binary"
START_FLOOR = 1e-6
ROWS_PER_BLOCK = 256
#: Iterations from one writing of W to the next, at most; steps of blocks that a core goes through again in place of one writing.
STEPS_PER_WRITE, BLOCKS_PER_WRITE = 3, 400
#: Sums are of whole multiples of this unit, so that they don't depend on the order or grouping of rows.
UNIT = 2.0**-34
#: The same for the entries of V in V'V; so many rows of products of these fit a double exactly in any case.
GRAM_UNIT, GRAM_ROWS = 2.0**-24, 32
EXACT = 2.0**53
#: Blocks' sums are held back until an entry might reach this, so that few are carried.
HELD = 2**62
#: Partial sums that the driver or a task adds at a time, and their bytes at most.
SUMS_AT_ONCE, SUM_BYTES = 64, 1 << 27


# ---- rows of V and W as arrays inside a task ------------------------------------------------
@dataclass
class Rows:
    """Some non-empty rows of V: row i holds positions starts[i]:starts[i + 1] of terms and weights."""

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    @classmethod
    def from_arrow(cls, terms: pa.Array, weights: pa.Array) -> Rows:
        """Rows of two list columns; no list may be null or empty."""
        lengths = np.asarray(pc.list_value_length(terms), np.int64)
        return cls(
            np.concatenate([[0], np.cumsum(lengths)]),
            np.asarray(terms.flatten(), np.int64),
            np.asarray(weights.flatten(), np.float64),
        )

    @cached_property
    def row(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """This block of V times a (terms x k) matrix; a column at a time, whose numbers lie side by side."""
        products, sums = np.empty(len(self.terms)), np.empty((matrix.shape[1], len(self.starts) - 1))
        for column, out in zip(np.ascontiguousarray(matrix.T), sums, strict=True):
            np.take(column, self.terms, out=products, mode="clip")  # the fastest way; terms were checked before, so none is clipped
            products *= self.weights
            np.add.reduceat(products, self.starts[:-1], out=out)
        return sums.T

    def transposed_times(self, w: np.ndarray, n_terms: int) -> np.ndarray:
        """W' V of this block, (k x terms), in units."""
        lengths, units, sums = np.diff(self.starts), self.weights / UNIT, np.empty((w.shape[1], n_terms))
        for k in range(w.shape[1]):
            products = np.repeat(w[:, k], lengths)
            products *= units
            sums[k] = np.bincount(self.terms, weights=np.rint(products, out=products), minlength=n_terms)
        return sums

    def gram(self, n_terms: int) -> np.ndarray:
        """V' V of this block, in squared units; V is rounded to units first."""
        rounded, total = np.rint(self.weights / GRAM_UNIT), np.zeros((n_terms, n_terms), np.int64)
        ranges = [(low, min(low + ROWS_PER_BLOCK, len(self.starts) - 1)) for low in range(0, len(self.starts) - 1, ROWS_PER_BLOCK)]
        while ranges:
            low, high = ranges.pop()
            ends = self.starts[low : high + 1]
            inside = slice(ends[0], ends[-1])
            # no sum of products is above the greatest sum of squares; where that might not fit a double exactly, fewer rows are taken
            squares = np.bincount(self.terms[inside], weights=rounded[inside] * rounded[inside], minlength=n_terms)
            if high - low > GRAM_ROWS and squares.max() >= EXACT:
                ranges += [(low, (low + high) // 2), ((low + high) // 2, high)]
                continue
            dense = np.zeros((high - low, n_terms))
            dense[np.repeat(np.arange(high - low), np.diff(ends)), self.terms[inside]] = rounded[inside]
            total += (dense.T @ dense).astype(np.int64)
        return total


def descend(target: np.ndarray, cross: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """One sweep over the columns of ``target`` (rows x k) in place; returns the projected gradient's size by row."""
    violation, columns, crossed = np.zeros(len(target)), np.ascontiguousarray(target.T), np.ascontiguousarray(cross.T)
    for k, column in enumerate(columns):
        gradient = (columns * gram[:, k, None]).sum(axis=0)
        gradient -= crossed[k]
        violation += np.abs(np.where(column == 0, np.minimum(gradient, 0), gradient))
        if gram[k, k] != 0:
            gradient /= gram[k, k]
            np.maximum(column - gradient, 0, out=column)
    target[:] = columns.T
    return violation


@dataclass(frozen=True)
class Start:
    """What the first W of a row needs: right singular vectors, singular values, signs and norms."""

    vectors: np.ndarray
    values: np.ndarray
    signs: np.ndarray
    scales: np.ndarray

    def first_w(self, rows: Rows) -> np.ndarray:
        left = rows.times(self.vectors) / self.values
        part = np.where(self.signs == 0, np.abs(left), np.maximum(left * self.signs, 0))
        w = part * self.scales
        w[w < START_FLOOR] = 0
        return w


def replay(rows: Rows, w: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Bring W through the given H one after the other; returns the last sweep's violation by row."""
    violation = np.zeros(len(w))
    for h in steps:
        violation = descend(w, rows.times(h.T), h @ h.T)
    return violation


# ---- exact sums in a tree -------------------------------------------------------------------
class Sum:
    """A sum of arrays of whole numbers in two limbs, so that any number of blocks fits."""

    def __init__(self, size: int):
        self.high, self.low = np.zeros(size, np.int64), np.zeros(size, np.int64)
        #: Added up but not yet carried into the limbs, and what no entry of it exceeds.
        self.held, self.most = np.zeros(size, np.int64), 0

    def add(self, units: np.ndarray) -> None:
        units = units.astype(np.int64)
        most = max(abs(int(units.max())), abs(int(units.min())))
        if self.most + most >= HELD:
            self._settle()
        self.held += units
        self.most += most

    def _settle(self) -> None:
        self._carry(self.high + (self.held >> 32), self.low + (self.held & 0xFFFFFFFF))
        self.held, self.most = np.zeros(len(self.held), np.int64), 0

    def merge(self, packed: bytes) -> None:
        high, low = np.frombuffer(packed, np.int64).reshape(2, -1)
        self._carry(self.high + high, self.low + low)

    def _carry(self, high: np.ndarray, low: np.ndarray) -> None:
        self.high, self.low = high + (low >> 32), low & 0xFFFFFFFF

    def packed(self) -> bytes:
        self._settle()
        return np.stack([self.high, self.low]).tobytes()

    def values(self, unit: float) -> np.ndarray:
        self._settle()
        return (self.high.astype(np.float64) * 2.0**32 + self.low) * unit


def block_sums(blocks: DataFrame, of_block: Callable[[pd.Series], np.ndarray], size: int) -> DataFrame:
    """(part, packed): a row per partition with the sum over its blocks of an array of whole numbers."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Sum(size)
        for batch in batches:
            for _, row in batch.iterrows():
                total.add(of_block(row))
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "packed": [total.packed()]})

    return blocks.mapInPandas(sums, "part int, packed binary")


def tree_sum(parts: DataFrame, size: int, unit: float, tasks: int) -> np.ndarray:
    """The sum of (part, packed) rows of ``tasks`` partitions, in multiples of ``unit``.

    Few such rows go to the driver; of many, some are added at a time in tasks, until few are left. So neither the
    driver nor a task ever holds more than a few sums.
    """

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = Sum(size)
        for packed in frame["packed"]:
            total.merge(packed)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "packed": [total.packed()]})

    n = tasks
    at_once = max(2, min(SUMS_AT_ONCE, SUM_BYTES // (16 * size)))
    while n > at_once:
        n = -(-n // at_once)
        parts = parts.groupBy(F.pmod("part", F.lit(n)).alias("g")).applyInPandas(merge, "part int, packed binary")
    total = Sum(size)
    for row in parts.select("packed").collect():
        total.merge(bytes(row["packed"]))
    return total.values(unit)


# ---- distributed passes ---------------------------------------------------------------------
def sparse_parts(vector: str) -> tuple[Column, Column]:
    """Term places and weights of a sparse vector column."""
    return F.col(vector)["indices"], F.col(vector)["values"]


def _pack(features: DataFrame, vector: str) -> DataFrame:
    terms, weights = sparse_parts(vector)
    filled = features.select(terms.alias("terms"), weights.alias("weights")).where(F.size("terms") > 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_PER_BLOCK):
                rows = Rows.from_arrow(*batch.slice(low, ROWS_PER_BLOCK).columns)
                short = rows.terms.min() >= 0 and rows.terms.max() < 1 << 16
                parts = [number, rows.starts.tobytes(), rows.terms.astype(np.uint16 if short else np.int64).tobytes(), rows.weights.tobytes()]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([part]) for part in parts], names=["block", "starts", "terms", "weights"])

    return filled.mapInArrow(pack, V_SCHEMA)


def _rows(row) -> Rows:
    weights = np.frombuffer(row["weights"], np.float64)
    short = len(row["terms"]) < 8 * len(weights)  # places of terms take two bytes where they fit
    terms = np.frombuffer(row["terms"], np.uint16 if short else np.int64).astype(np.int64)
    return Rows(np.frombuffer(row["starts"], np.int64), terms, weights)


def _start(blocks: DataFrame, k: int, n_terms: int, tasks: int) -> tuple[Start, np.ndarray]:
    """NNDSVD from the Gram matrix, which is summed in a tree and whose size the vocabulary bounds."""
    products = block_sums(blocks, lambda row: _rows(row).gram(n_terms).ravel(), n_terms * n_terms)
    gram = tree_sum(products, n_terms * n_terms, GRAM_UNIT**2, tasks).reshape(n_terms, n_terms)
    eigenvalues, eigenvectors = np.linalg.eigh(gram)
    top = np.argsort(eigenvalues)[::-1][:k]
    values = np.sqrt(np.maximum(eigenvalues[top], 0))
    vectors = eigenvectors[:, top]
    if len(top) < k:  # fewer terms than topics
        values, vectors = np.pad(values, (0, k - len(top))), np.pad(vectors, ((0, 0), (0, k - len(top))))
    noise = max(np.sqrt(len(gram) * np.finfo(float).eps), np.sqrt(GRAM_UNIT))  # eigenvalues carry noise of that square
    present = values > max(values[0], 1e-300) * noise
    divisor = np.where(present, values, 1.0)

    def squares(row) -> np.ndarray:
        left = _rows(row).times(vectors) / divisor
        parts = np.stack([np.maximum(left, 0) ** 2, np.minimum(left, 0) ** 2])
        return np.rint(parts / UNIT).sum(axis=1).ravel()

    sums = tree_sum(block_sums(blocks, squares, 2 * k), 2 * k, UNIT, tasks).reshape(2, k)
    signs, scales, h = np.zeros(k), np.zeros(k), np.zeros((k, vectors.shape[0]))
    for j in range(k):
        if not present[j]:
            signs[j] = 1
            continue
        right = vectors[:, j]
        if j == 0:
            scales[j] = np.sqrt(values[j])
            h[j] = scales[j] * np.abs(right)
            continue
        left_norms = np.sqrt(sums[:, j])
        right_parts = [np.maximum(right, 0), np.maximum(-right, 0)]
        sizes = [left_norms[s] * np.linalg.norm(right_parts[s]) for s in (0, 1)]
        side = 0 if sizes[0] > sizes[1] else 1
        if not sizes[side] > 0:
            signs[j] = 1
            continue
        weight = np.sqrt(values[j] * sizes[side])
        signs[j] = 1 if side == 0 else -1
        scales[j] = weight / left_norms[side]
        h[j] = weight * right_parts[side] / np.linalg.norm(right_parts[side])
    h[h < START_FLOOR] = 0
    return Start(vectors, divisor, signs, scales), h


@dataclass
class NmfModel:
    """H, and what it takes to compute the W of a row: the start and every H it went through."""

    components: np.ndarray
    start: Start
    steps: list[np.ndarray]
    violations: list[float]

    def weights(self, terms: Column, weights: Column, df: DataFrame) -> Column:
        """W of each row, from its sparse vector alone; only the vector travels to Python.

        Declared as not deterministic, though it is: so no filter on its result makes a copy of it.
        """
        compute = self.of_lists(df)
        compute.__annotations__ = {"term_lists": pa.Array, "weight_lists": pa.Array, "return": pa.Array}
        return F.arrow_udf(compute, "array<double>").asNondeterministic()(terms, weights)

    def of_lists(self, df: DataFrame) -> Callable[[pa.Array, pa.Array], pa.Array]:
        """W of rows whose sparse vectors are two list columns, as a function for the tasks of the frame's session."""
        shared = df.sparkSession.sparkContext.broadcast((self.start, self.steps))
        k, n_terms = self.components.shape

        def compute(term_lists: pa.Array, weight_lists: pa.Array) -> pa.Array:
            start, steps = shared.value
            w = np.zeros((len(term_lists), k))
            filled = np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(term_lists), 0)))
            for low in range(0, len(filled), ROWS_PER_BLOCK):
                some = filled[low : low + ROWS_PER_BLOCK]
                rows = Rows.from_arrow(term_lists.take(some), weight_lists.take(some))
                if rows.terms.min() < 0 or rows.terms.max() >= n_terms:
                    raise IndexError(f"terms are numbered from 0 to {n_terms - 1}")
                own = start.first_w(rows)
                replay(rows, own, steps)
                w[some] = own
            return pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, k), pa.int32()), pa.array(w.ravel()))

        return compute


def fit_nmf(
    features: DataFrame, vector: str, k: int = 8, max_iter: int = 200, tolerance: float = 1e-4, n_terms: int | None = None
) -> NmfModel:
    """Factorise the rows of a sparse vector column; stops when the violation falls to ``tolerance`` of the first.

    The factors are the same to the last digit however the rows are partitioned. V is written and dealt out by block
    once; W is dealt out alike, so that putting them side by side moves neither, and is written every few steps.
    """
    packed = write_and_read(spread_small_input(_pack(features, vector)), "nmf-v")
    if n_terms is None:
        n_terms = 1 + (features.agg(F.max(F.array_max(sparse_parts(vector)[0]))).first()[0] or 0)
    tasks = _whole_rounds(packed.rdd.getNumPartitions(), features.sparkSession.sparkContext.defaultParallelism)
    v = _by_block(packed, tasks)
    start, h = _start(v, k, n_terms, tasks)
    every = _steps_per_write(v.count(), features.sparkSession.sparkContext.defaultParallelism)
    blocks, w, written, pending, steps, violations, size = v, None, None, [], [], [], k * (n_terms + k) + 1
    for _ in range(max_iter):
        pending.append(h.copy())
        shared = v.sparkSession.sparkContext.broadcast((start, pending))
        writes = len(pending) == every
        passed = _advance(blocks, shared, size, writes)
        if writes:
            passed = write_and_read(passed, "nmf-w")
        whole = tree_sum(passed.where("packed is not null").select("part", "packed"), size, UNIT, tasks)
        shared.destroy()
        cross, gram, violation = whole[: k * n_terms].reshape(k, n_terms), whole[k * n_terms : -1].reshape(k, k), whole[-1]
        target = h.T.copy()
        violation += float(descend(target, cross.T, gram).sum())
        h = target.T.copy()
        steps.append(pending[-1])
        violations.append(violation)
        if writes:
            _let_go(w, written)
            written, pending = passed, []
            w = _by_block(written.where("packed is null").select("block", "w"), tasks)
            blocks = v.join(w, "block")
        if violations[0] == 0 or violation / violations[0] <= tolerance:
            break
    _let_go(w, written)
    _let_go(v, packed)
    return NmfModel(h, start, steps, violations)


def _steps_per_write(blocks: int, cores: int) -> int:
    """How rarely W is written: going through a few blocks again costs less than a table does, through many it costs more."""
    return max(1, min(STEPS_PER_WRITE, BLOCKS_PER_WRITE * cores // max(blocks, 1)))


def _let_go(kept: DataFrame | None, written: DataFrame | None) -> None:
    """A frame that is kept, and the table that it was read from, are needed no more."""
    if written is not None:
        kept.unpersist()
        delete_written(written)


def _whole_rounds(partitions: int, cores: int) -> int:
    """As many tasks at least, so that all cores are busy to the end of a pass."""
    return -(-max(partitions, 1) // cores) * cores


def _by_block(df: DataFrame, tasks: int) -> DataFrame:
    """Dealt out and sorted by block, so that tables dealt out alike are joined where they are."""
    return df.repartition(tasks, "block").sortWithinPartitions("block").persist()


def _advance(blocks: DataFrame, shared: Broadcast, size: int, writes: bool) -> DataFrame:
    """The sums W'V, W'W and the violation of each task after some steps from the blocks' W, or from the start; on request also that W."""

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, steps = shared.value
        k, n_terms = steps[0].shape
        total = Sum(size)
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                rows = _rows(row)
                w = np.frombuffer(row["w"], np.float64).reshape(-1, k).copy() if "w" in row else start.first_w(rows)
                violation = replay(rows, w, steps)
                gram = np.rint(w[:, :, None] * w[:, None, :] / UNIT).sum(axis=0)
                total.add(np.concatenate([rows.transposed_times(w, n_terms).ravel(), gram.ravel(), [np.rint(violation / UNIT).sum()]]))
                out.append(w.tobytes())
            if writes:
                yield pd.DataFrame({"block": batch["block"].astype("Int64"), "w": out, "part": pd.array([None] * len(out), "Int32"), "packed": None})
        part = pd.array([TaskContext.get().partitionId()], "Int32")
        yield pd.DataFrame({"block": pd.array([None], "Int64"), "w": [None], "part": part, "packed": [total.packed()]})

    return blocks.mapInPandas(move, W_SCHEMA)
