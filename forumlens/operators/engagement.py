"""Engagement: weighted score, ratio, comment count, comment quality and recency."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.numeric import clamp, half_even


def comment_quality() -> Column:
    """(mean + best comment score) * 5 within 0-100; 0 without collected comments."""
    scores = F.transform("comments", lambda c: F.coalesce(c["score"], F.lit(0)))
    total = F.aggregate(scores, F.lit(0).cast("bigint"), lambda a, s: a + s)
    value = (total / F.size(scores) + F.array_max(scores)) * 5
    usable = (F.size("comments") > 0) & (F.col("comments_collected") != 0)
    return F.when(usable, clamp(value, 0, 100)).otherwise(0.0)


def comment_quality_flat(comments: DataFrame) -> DataFrame:
    """The same from flat comment rows: one row per post that has any."""
    score = F.coalesce(F.col("score"), F.lit(0))
    stats = comments.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("comments_collected"), F.avg(score).alias("avg_comment_score"),
        F.max(score).alias("max_comment_score"),
    )
    value = clamp((F.col("avg_comment_score") + F.col("max_comment_score")) * 5, 0, 100)
    return stats.withColumn("comment_quality_score", value)


def recency(columns: set[str]) -> Column:
    """100 now, 50 after a day, 0 after two; by days if hours are unknown, else neutral."""
    if "hours_ago" in columns:
        return clamp(100 - F.col("hours_ago") / 24 * 50, 0, 100)
    if "days_ago" in columns:
        return clamp(100 - F.col("days_ago") * 50 / 14, 0, 100)
    return F.lit(50.0)


def calculate_engagement(df: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Adds the five parts and ``engagement_score``.

    Counts are scaled by the maxima over this very frame, read by a scalar subquery that needs two
    columns only. Filter before, not after: the maxima change with the rows.
    """
    weights = weights or fixed.DEFAULT_WEIGHTS
    present = set(df.columns)
    counted = [c for c in ("score", "num_comments") if c in present]
    tops = {}
    if counted:
        best = df.agg(F.struct(*[F.max(c).alias(c) for c in counted]).alias("tops"))
        df = df.withColumn("_tops", best.scalar())
        for name in counted:
            top = F.col("_tops")[name]
            tops[name] = F.when(top > 0, top).otherwise(1)

    def scaled(name: str) -> Column:
        return clamp(F.col(name) / tops[name] * 100, 0, 100) if name in tops else F.lit(0.0)

    has_comments = {"comments", "comments_collected"} <= present
    ratio = clamp(F.col("upvote_ratio") * 100, 0, 100) if "upvote_ratio" in present else F.lit(50.0)
    parts = {
        "score_normalized": scaled("score"),
        "upvote_ratio_normalized": ratio,
        "comments_normalized": scaled("num_comments"),
        "comment_quality_score": comment_quality() if has_comments else F.lit(0.0),
        "recency_score": recency(present),
    }
    total = F.lit(0.0)
    for part, weight in zip(parts, ("score", "upvote_ratio", "comments", "comments_quality", "recency"), strict=True):
        total = total + F.col(part) * float(weights[weight])
    return df.withColumns(parts).withColumn("engagement_score", half_even(total, 2)).drop("_tops")
