"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a``, ``b``: long) but the smallest of its component.

    Each round links a node's larger neighbours, then its smaller ones, to the smallest node it knows. Rounds
    grow with the logarithm of the longest path. Minima are written before they are joined, so that adaptive
    execution can split the links of a hub. No link, or links of a node to itself: an empty frame.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, step, before = scratch.save(edges, "edges0"), 0, None
    while (now := _state(edges)) != before:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        lowest = scratch.save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"large{step}")
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.save(large, f"stars{step}")
        least = scratch.save(large.groupBy("a").agg(F.min("b").alias("m")), f"small{step}")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, step = now, step + 1
        edges = scratch.save(small.union(least).distinct(), f"edges{step}")
    return edges.toDF("node", "component")
