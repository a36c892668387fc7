"""Work tables in the shared folder, and small numpy helpers that several operators use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's, or on one machine a temporary one."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/checkpoints"
        spark.conf.set(CHECKPOINT_DIR, base)
    return base.rstrip("/")


class Scratch:
    """Work tables of one run. A saved table has no lineage, so a lost executor costs a second read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more, and let Spark remove the shuffle files of dropped frames."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        jvm.System.gc()


# ---- arrays --------------------------------------------------------------------------------
def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values in a sorted array."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.append(starts, len(keys)))


def products(
    left_start: np.ndarray, left_n: np.ndarray, right_start: np.ndarray, right_n: np.ndarray, batch: int = 1 << 21
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of several left-times-right rectangles, in batches of bounded size."""
    rows = np.repeat(np.arange(len(left_start)), left_n)
    left = np.repeat(left_start - np.cumsum(left_n) + left_n, left_n) + np.arange(left_n.sum())
    width = right_n[rows]
    at = np.concatenate([[0], np.cumsum(width)])
    i = 0
    while i < len(rows):
        j = max(i + 1, int(np.searchsorted(at, at[i] + batch, side="right")) - 1)
        n = width[i:j]
        offset = np.arange(at[j] - at[i]) - np.repeat(at[i:j] - at[i], n)
        first, right = np.repeat(left[i:j], n), np.repeat(right_start[rows[i:j]], n) + offset
        for k in range(0, len(first), batch):
            yield first[k : k + batch], right[k : k + batch]
        i = j


class RollingHash:
    """64-bit polynomial hashes of any stretch of a byte array, from one pass of sums; equal bytes, equal hash."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(0, 2**64, 256, dtype=np.uint64)
        base = int(rng.integers(2**62, 2**63)) * 2 + 1
        self.bases = np.uint64(base % 2**64), np.uint64(pow(base, -1, 2**64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Sums of coded bytes up to each position; ``data`` is uint8."""
        if len(data) >= len(self.powers):
            n = max(1 << 12, len(data) * 5 // 4)
            self.powers, self.inverses = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, b)])) for b in self.bases)
        out = np.zeros(len(data) + 1, np.uint64)
        terms = self.codes[data]
        terms *= self.powers[: len(data)]
        np.cumsum(terms, out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.inverses[starts]


class Forest:
    """Connected groups of 0..n-1, joined by batches of links; the smallest member names a group."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        differ = a != b
        if not differ.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b)[differ], np.maximum(a, b)[differ]]), axis=1)
        parent = {}

        def find(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        for x, y in zip(*pairs.tolist(), strict=True):
            x, y = sorted((find(x), find(y)))
            if x != y:
                parent[y] = x
        moved = np.arange(len(self.root))
        for x in parent:
            moved[x] = find(x)
        self.root = moved[self.root]
