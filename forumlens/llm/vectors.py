"""Near-duplicate vectors by binary codes of a random rotation (RaBitQ).

Each unit vector is padded to ``BITS`` dimensions and rotated; its code is the signs, and its correction factor
the inner product with its own code. From a code, its factor and another rotated vector follows an unbiased
estimate of their cosine, with a confidence bound. Slices of the code are the keys of hash tables; what meets
under a key is estimated first, and only pairs whose upper bound reaches the threshold are computed exactly, in
double precision. Equal vectors are one row; pairs are never written, only counts and connecting links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import Forest, Scratch, products, runs
from forumlens.llm.components import components

THRESHOLD = 0.95
#: Tables, and the bits of a key. A pair at cosine 0.95 shares a bit with probability 0.899, so it misses all
#: of 24 keys of 16 bits with probability 0.008; a pair at 0.98 with probability 0.000005.
TABLES, KEY_BITS = 24, 16
BITS = TABLES * KEY_BITS
#: Standard deviations of the estimate's error that the confidence bound spans.
SPREAD = 4.0
ROWS_PER_TASK = 20_000
#: Rows of a key that are compared in one task; more are cut into blocks, and every pair of blocks is one task.
BLOCK_ROWS = 2_048
SEED = 7


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """``dims`` orthonormal columns of length ``BITS`` or ``dims``: a random rotation of the padded space."""
    size = max(BITS, dims)
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((size, dims)))
    return q * np.sign(np.diag(r))


def encode(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes as keys of 16 bits, and correction factors of unit vectors."""
    turned = units @ turn.T
    signs = turned >= 0
    factor = np.abs(turned).sum(1) / np.sqrt(turned.shape[1])
    return np.packbits(signs[:, :BITS], axis=1).view(">u2").astype(np.uint16), factor


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare(frame: pd.DataFrame, threshold: float, kind: str) -> pd.DataFrame:
    """Counts of new links and connecting links of the rows of one task: ``kind`` 0 (node, n) or 1 (node, other)."""
    frame = frame.sort_values(["table", "key", "blocks", "right", "node"], ignore_index=True)
    x = _unit(np.frombuffer(b"".join(frame["vector"]), kind).reshape(len(frame), -1))
    keys = np.frombuffer(b"".join(frame["code"]), np.uint16).reshape(len(frame), -1)
    turn = rotation(x.shape[1])
    size = turn.shape[0]
    turned = x @ turn.T
    signs = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(size)
    factor = np.abs(turned).sum(1) / np.sqrt(size)
    error = SPREAD * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / np.sqrt(max(1, size - 1))
    node, weight, table = (frame[c].to_numpy(np.int64) for c in ("node", "n", "table"))
    group = np.unique(frame[["table", "key", "blocks"]].to_numpy(np.int64), axis=0, return_inverse=True)[1]
    right = frame["right"].to_numpy(bool)
    starts, sizes = runs(group)
    rights = np.add.reduceat(right.astype(np.int64), starts)
    whole = rights == 0  # one block against itself: every row against the later ones
    a = np.where(whole, sizes, sizes - rights)
    b_start, b_size = np.where(whole, starts, starts + sizes - rights), np.where(whole, sizes, rights)
    same = np.repeat(whole, sizes)
    names, where = np.unique(node, return_inverse=True)
    counts, forest = np.zeros(len(names), np.int64), Forest(len(names))
    for i, j in products(starts, a, b_start, b_size, 1 << 16):
        keep = (node[i] < node[j]) | ~same[i]
        i, j = i[keep], j[keep]
        estimate = np.einsum("ij,ij->i", signs[i], turned[j]) / factor[i]
        likely = estimate + error[i] >= threshold
        i, j = i[likely], j[likely]
        linked = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
        i, j = i[linked], j[linked]
        forest.link(where[i], where[j])
        first = np.argmax(keys[i] == keys[j], axis=1) == table[i]  # count a pair in its first common table only
        np.add.at(counts, where[i[first]], weight[j[first]])
        np.add.at(counts, where[j[first]], weight[i[first]])
    some, moved = np.flatnonzero(counts), np.flatnonzero(forest.root != np.arange(len(names)))
    return pd.DataFrame({
        "kind": np.repeat([0, 1], [len(some), len(moved)]), "node": np.concatenate([names[some], names[moved]]),
        "value": np.concatenate([counts[some], names[forest.root[moved]]]),
    })


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row: links of cosine ``threshold`` or more.

    Vectors that are null, empty, zero or not finite throughout link with nothing, nor do vectors of different
    lengths. Equal vectors link; repeated rows come back repeated and count as vectors of their own, so that
    ``n_links`` may exceed the ids. Rows without an id are counted but name no component while another row can;
    a component of none but such rows has no id and is not kept. Other columns are not read. The search misses
    the share of pairs that ``TABLES`` and ``KEY_BITS`` state; a cosine below ``threshold`` is never linked.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    bad = F.coalesce(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists("v", lambda x: x != 0), F.lit(True))
    digest = F.when(~bad, F.sha2(F.array_join(F.transform("v", lambda x: (x + 0.0).cast("string")), ","), 256))
    rows = scratch.save(rows.withColumn("digest", digest), "rows")
    good = rows.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("v").alias("v"))
    good = scratch.save(good.withColumn("node", F.xxhash64("digest")), "classes")
    tasks = 1 + good.count() * TABLES // ROWS_PER_TASK

    # what is carried keeps the precision of the column
    kind = "<f4" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "<f8"

    def index(frames):
        for f in frames:
            for dims, part in f.groupby(f["v"].map(len)):
                x = np.array(part["v"].tolist(), np.float64)
                keys, _ = encode(_unit(x), rotation(int(dims)))
                values, codes = [r.tobytes() for r in x.astype(kind)], [r.tobytes() for r in keys]
                for t in range(TABLES):
                    yield pd.DataFrame({"table": t, "key": keys[:, t].astype(np.int64) + (int(dims) << 16), "node": part["node"], "n": part["n"], "code": codes, "vector": values})

    slots = good.select("node", "n", "v").mapInPandas(index, "table int, key long, node long, n long, code binary, vector binary")
    hot = slots.groupBy("table", "key").agg(F.count("*").alias("m")).where(f"m > {BLOCK_ROWS}")
    cut = scratch.save(hot.select("table", "key", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("cuts")), "hot")
    placed = slots.join(cut, ["table", "key"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("cuts")).cast("int")
    pair = lambda o: F.struct((F.least(mine, o) * 65536 + F.greatest(mine, o)).alias("blocks"), (mine > o).alias("right"))
    placed = placed.select("*", F.explode(F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), pair)).alias("p")).select("*", "p.*").drop("p", "cuts")
    placed = placed.withColumn("task", F.pmod(F.xxhash64("table", "key", "blocks"), F.lit(tasks)))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [_compare(f, threshold, kind) for _, f in frame.groupby(frame["vector"].map(len))]
        return pd.concat(parts, ignore_index=True)

    found = scratch.save(placed.groupBy("task").applyInPandas(compare, "kind int, node long, value long"), "found")
    counts = found.where("kind = 0").groupBy("node").agg(F.sum("value").alias("others"))
    group = components(found.where("kind = 1").select(F.col("node").alias("a"), F.col("value").alias("b")), scratch)
    classes = good.select("digest", "node", "low", "n").join(counts, "node", "left").join(group, "node", "left")
    classes = scratch.save(classes.withColumn("component", F.coalesce("component", "node")), "joined")
    lowest = scratch.save(classes.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    classes = classes.join(lowest, "component").select("digest", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    scratch.drop("found")
    out = rows.select("vec_id", "digest").join(scratch.save(classes, "classed"), "digest", "left")
    id_of = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), id_of.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
