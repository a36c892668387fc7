"""Collection from landed tables, alone or followed by the combined analysis, in one session."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.operators import reports
from forumlens.operators.collect import (
    attach_comments, collect_user_comments, collection_summary, tiered_collection, top_comments, user_stats,
)
from forumlens.operators.ranking import dedupe_posts
from forumlens.operators.search import hybrid_search
from forumlens.plans.analysis import STRICT, Analysis, Settings, analyze
from forumlens.sources.files import combine_collections


@dataclass(frozen=True)
class SearchSettings:
    target_keywords: list[str] = field(default_factory=lambda: list(fixed.TARGET_KEYWORDS))
    broad_terms: list[str] = field(default_factory=lambda: list(fixed.BROAD_TERMS))
    subreddits: list[str] | None = field(default_factory=lambda: list(fixed.SEARCH_SUBREDDITS))
    limit_per_term: int = 30
    max_comments: int = 200


def daily_collection(
    posts: DataFrame, comments: DataFrame | None = None, tiers: Mapping[str, Mapping] = fixed.TIERS,
    max_comments: int = 200,
) -> DataFrame:
    """Tiered posts with their best comments. Comments of other posts are dropped before ranking."""
    collected = tiered_collection(posts, tiers)
    if comments is None:
        return attach_comments(collected, None)
    own = comments.join(collected.select(F.col("id").alias("post_id")).distinct(), "post_id", "left_semi")
    return attach_comments(collected, top_comments(own, max_comments))


def tier_place(tiers: Mapping[str, Mapping]) -> Column:
    """The place of a post's tier among the tiers, from 1: a post of several tiers belongs to the first."""
    return F.array_position(F.array(*[F.lit(t) for t in tiers]), F.col("activity_tier"))


def search_collection(
    posts: DataFrame, comments: DataFrame | None, as_of: float, settings: SearchSettings | None = None
) -> DataFrame:
    s = settings or SearchSettings()
    return hybrid_search(
        posts, comments, s.target_keywords, s.broad_terms, s.subreddits, s.limit_per_term, s.max_comments, as_of
    )


def user_collection(comments: DataFrame, users: list[str], limit: int = 1000) -> tuple[DataFrame, DataFrame]:
    """The named users' comments and their statistics."""
    collected = collect_user_comments(comments, users, limit)
    return collected, user_stats(collected, users)


def daily_report(collected: DataFrame, tiers: Mapping[str, Mapping] = fixed.TIERS) -> dict[str, DataFrame]:
    return {
        "collection_overview": reports.collection_overview(collected),
        "collection_summary": collection_summary(collected, tiers),
        "tier_stats": reports.tier_stats(collected),
        "top_posts_per_tier": reports.top_posts_per_tier(collected),
        "posts_per_subreddit": reports.value_counts(collected, "subreddit"),
    }


def search_report(found: DataFrame) -> dict[str, DataFrame]:
    return {
        "collection_overview": reports.collection_overview(found),
        "match_type_counts": reports.match_type_counts(found),
        "posts_per_term": reports.value_counts(found, "broad_search_term"),
        "posts_per_location": reports.value_counts(found, "search_location"),
        "posts_per_subreddit": reports.value_counts(found, "subreddit", 10),
        "keyword_frequency": reports.keyword_frequency(found),
    }


def collect_and_analyze(
    posts: DataFrame, comments: DataFrame | None, as_of: float, kind: str = "both",
    tiers: Mapping[str, Mapping] = fixed.TIERS, search: SearchSettings | None = None, settings: Settings = STRICT,
) -> Analysis:
    """Daily, search or both collections, united and analysed."""
    frames = []
    if kind in ("daily", "both"):
        daily = daily_collection(posts, comments, tiers).withColumn("_place", tier_place(tiers))
        frames.append(daily.withColumn("collection_type", F.lit("daily_subreddits")))
    if kind in ("search", "both"):
        found = search_collection(posts, comments, as_of, search)
        frames.append(found.withColumn("collection_type", F.lit("keyword_search")))
    if not frames:
        raise ValueError(f"unknown kind: {kind}")
    united = combine_collections(frames)
    order = ["file_order", *(["_place"] if "_place" in united.columns else []), "created_utc"]
    return analyze(dedupe_posts(united, order).drop("_place"), settings)
