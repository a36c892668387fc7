"""Threshold filters, keyword exclusion and the two-tier rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.numeric import no_nan
from forumlens.functions.text import contains_any

LOWER_BOUNDS = {
    "min_engagement_score": "engagement_score", "min_score": "score",
    "min_comments": "num_comments", "min_upvote_ratio": "upvote_ratio",
}
UPPER_BOUNDS = {"max_hours_ago": "hours_ago", "max_days_ago": "days_ago"}


def has_keywords_in_comments(keywords: list[str]) -> Column:
    """Any nested comment body holds any keyword, case ignored; false without collected comments."""
    lowered = [k.lower() for k in keywords]
    found = F.exists("comments", lambda c: F.coalesce(contains_any(F.lower(c["body"]), lowered), F.lit(False)))
    return F.coalesce(found & (F.col("comments_collected") != 0), F.lit(False))


def threshold_steps(df: DataFrame, thresholds: Mapping) -> dict[str, Column]:
    """The predicates in the order they apply. Null and NaN fail; age bounds need their column."""
    steps: dict[str, Column] = {}

    def value(name: str) -> Column:
        column = F.col(name)
        return no_nan(column) if dict(df.dtypes)[name] in ("double", "float") else column

    for key, name in LOWER_BOUNDS.items():
        if key in thresholds:
            steps[key] = value(name) >= thresholds[key]
    for key, name in UPPER_BOUNDS.items():
        if key in thresholds and name in df.columns:
            steps[key] = value(name) <= thresholds[key]
    if "subreddits" in thresholds:
        steps["subreddits"] = F.col("subreddit").isin(list(thresholds["subreddits"]))
    if thresholds.get("exclude_keywords") and "comments" in df.columns:
        steps["exclude_keywords"] = ~has_keywords_in_comments(thresholds["exclude_keywords"])
    return {key: F.coalesce(step, F.lit(False)) for key, step in steps.items()}


def passes_thresholds(df: DataFrame, thresholds: Mapping) -> Column:
    passed = F.lit(True)
    for step in threshold_steps(df, thresholds).values():
        passed = passed & step
    return passed


def filter_by_thresholds(df: DataFrame, thresholds: Mapping) -> DataFrame:
    return df.where(passes_thresholds(df, thresholds))


def threshold_funnel(df: DataFrame, thresholds: Mapping) -> DataFrame:
    """Rows left after each predicate in turn, from one pass: (step_ord, step, remaining)."""
    names, passed, counts = ["start"], F.lit(True), [F.count(F.lit(1))]
    for name, step in threshold_steps(df, thresholds).items():
        passed = passed & step
        names.append(name)
        counts.append(F.count_if(passed))
    totals = df.agg(*[c.alias(f"_c{i}") for i, c in enumerate(counts)])
    rows = [
        F.struct(F.lit(i).alias("step_ord"), F.lit(n).alias("step"), F.col(f"_c{i}").alias("remaining"))
        for i, n in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*rows)))


def exclude_by_flat_comments(posts: DataFrame, comments: DataFrame, keywords: list[str]) -> DataFrame:
    """The exclusion against a flat comment table: only ids of posts with a hit are shuffled."""
    lowered = [k.lower() for k in keywords]
    hit = comments.where(contains_any(F.lower("body"), lowered))
    return posts.join(hit.select(F.col("post_id").alias("id")).distinct(), "id", "left_anti")


def two_tier_filter(
    df: DataFrame, thresholds: Mapping | None, high: int = fixed.RELEVANCE_CUT
) -> DataFrame:
    """Relevant posts pass as they are, the rest must meet the thresholds; one predicate, no union."""
    if not thresholds:
        return df
    return df.where((F.col("relevance_score") >= high) | passes_thresholds(df, thresholds))
