"""Summaries of collected and analysed posts, each a small frame of its own.

All are plain grouped aggregates, so Spark combines rows before the shuffle and a subreddit that
holds a third of all posts costs one partial row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.numeric import half_even
from forumlens.operators.ranking import top_n_per_group


def _rows() -> Column:
    return F.count(F.lit(1))


def short_title(limit: int, title: str = "title") -> Column:
    long = F.char_length(title) > limit
    return F.when(long, F.concat(F.left(F.col(title), F.lit(limit)), F.lit("..."))).otherwise(F.col(title))


# ---- analysed posts ------------------------------------------------------------------------
def dataset_overview(df: DataFrame) -> DataFrame:
    """Size and span in time, which is null where posts have no time column."""
    created = F.col("created_datetime") if "created_datetime" in df.columns else F.lit(None).cast("timestamp")
    return df.agg(
        _rows().alias("total_posts"), F.countDistinct("subreddit").alias("unique_subreddits"),
        F.min(created).alias("first_created"), F.max(created).alias("last_created"),
    )


def engagement_summary(df: DataFrame) -> DataFrame:
    """Mean, exact median, range and bands.

    The median keeps a count per distinct value, and rounding to two digits bounds those.
    """
    score = F.col("engagement_score")
    return df.agg(
        half_even(F.avg(score), 2).alias("avg_engagement"), half_even(F.median(score), 2).alias("median_engagement"),
        F.min(score).alias("min_engagement"), F.max(score).alias("max_engagement"),
        F.count_if(score > 70).alias("high"), F.count_if((score >= 30) & (score <= 70)).alias("medium"),
        F.count_if(score < 30).alias("low"),
    )


def subreddit_stats(df: DataFrame) -> DataFrame:
    basis = "engagement_score" if "engagement_score" in df.columns else "score"
    return df.groupBy("subreddit").agg(
        F.count("score").alias("post_count"), half_even(F.avg("score"), 2).alias("avg_score"),
        half_even(F.avg("num_comments"), 2).alias("avg_comments"), half_even(F.avg(basis), 2).alias("avg_engagement"),
    )


def top_subreddits(df: DataFrame, n: int = 10) -> DataFrame:
    return subreddit_stats(df).orderBy(F.desc("avg_engagement"), F.asc("subreddit")).limit(n)


def top_posts(df: DataFrame, n: int = 10) -> DataFrame:
    basis = ["engagement_score"] if "engagement_score" in df.columns else []
    columns = ["id", short_title(60).alias("title"), "subreddit", "score", "num_comments", *basis]
    return df.orderBy(F.desc((basis or ["score"])[0]), F.asc("id")).limit(n).select(*columns)


def sentiment_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("overall_sentiment_class").agg(_rows().alias("posts"))


def topic_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("topic_name").agg(_rows().alias("posts"))


def relevance_summary(df: DataFrame, cut: int) -> DataFrame:
    """Before and after the gate, from a frame with scores of all posts."""
    kept = F.col("relevance_score") >= cut
    before, after = _rows(), F.count_if(kept)
    return df.agg(
        before.alias("original_posts"), after.alias("relevant_posts"), (before - after).alias("filtered_out"),
        half_even(F.try_divide(after * 100.0, before), 1).alias("relevant_pct"),
        half_even(F.avg(F.when(kept, F.col("relevance_score"))), 1).alias("avg_relevance"),
        F.max(F.when(kept, F.col("relevance_score"))).alias("max_relevance"),
    )


def analysis_report(df: DataFrame) -> dict[str, DataFrame]:
    report = {"dataset_overview": dataset_overview(df), "top_posts": top_posts(df), "top_subreddits": top_subreddits(df)}
    if "engagement_score" in df.columns:
        report["engagement_summary"] = engagement_summary(df)
    return report


# ---- collections ---------------------------------------------------------------------------
def collection_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("total_posts"), F.countDistinct("subreddit").alias("unique_subreddits"),
        half_even(F.avg("score"), 2).alias("avg_score"), half_even(F.avg("hours_ago"), 2).alias("avg_hours_ago"),
    )


def tier_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("activity_tier").agg(
        F.count("id").alias("posts"), half_even(F.avg("score"), 2).alias("avg_score"),
        half_even(F.avg("hours_ago"), 2).alias("avg_hours_ago"), F.countDistinct("subreddit").alias("subreddits"),
    )


def top_posts_per_tier(df: DataFrame, n: int = 3) -> DataFrame:
    best = top_n_per_group(df, ["activity_tier"], [F.desc("score"), F.asc("id")], n, rank_name="place")
    title = F.concat(F.left(F.col("title"), F.lit(50)), F.lit("..."))
    return best.select("activity_tier", "place", "id", "subreddit", title.alias("title"), "score", "hours_ago")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    counts = df.groupBy(column).agg(_rows().alias("posts")).orderBy(F.desc("posts"), F.asc(column))
    return counts.limit(top) if top else counts


def keyword_frequency(df: DataFrame) -> DataFrame:
    return (
        df.select(F.explode("matched_keywords").alias("keyword"))
        .groupBy("keyword").agg(_rows().alias("mentions")).orderBy(F.desc("mentions"), F.asc("keyword"))
    )


def match_type_counts(df: DataFrame) -> DataFrame:
    post, comments = F.col("found_in_post"), F.col("found_in_comments")
    return df.agg(
        _rows().alias("total"), F.count_if(post).alias("in_post"), F.count_if(comments).alias("in_comments"),
        F.count_if(post & comments).alias("in_both"), F.count_if(F.col("comments_collected") > 0).alias("with_comments"),
    )


def comment_totals(df: DataFrame) -> DataFrame:
    size = F.coalesce(F.size("comments"), F.lit(0))
    return df.agg(F.sum(size).alias("total_comments"), F.count_if(size > 0).alias("posts_with_comments"))


def comment_totals_flat(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """The same from flat comments, of any number per post; those of other posts do not count."""
    own = comments.join(posts.select(F.col("id").alias("post_id")), "post_id", "left_semi")
    sizes = own.groupBy("post_id").agg(_rows().alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_comments"), F.count("*").alias("posts_with_comments"))


# ---- users ---------------------------------------------------------------------------------
def user_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("total_comments"), F.countDistinct("subreddit").alias("unique_subreddits"),
        half_even(F.avg("score"), 2).alias("avg_score"),
        half_even(F.avg(F.char_length("body")), 0).alias("avg_length"),
        F.max("days_ago").alias("oldest_days"), F.min("days_ago").alias("newest_days"),
    )


def user_top_subreddits(df: DataFrame, n: int = 10) -> DataFrame:
    counts = df.groupBy("subreddit").agg(_rows().alias("comments"))
    return counts.orderBy(F.desc("comments"), F.asc("subreddit")).limit(n)


def recent_user_activity(df: DataFrame, days: int = 30) -> DataFrame:
    recent = F.col("days_ago") <= days
    return df.agg(
        F.count_if(recent).alias("recent_comments"), _rows().alias("total_comments"),
        half_even(F.avg(F.when(recent, F.col("score"))), 2).alias("recent_avg_score"),
    )


# ---- model scores --------------------------------------------------------------------------
def score_buckets(df: DataFrame, score: str = "llm_relevance_score") -> DataFrame:
    value = F.col(score)
    counts = {
        "high": F.count_if(value >= 70), "medium": F.count_if((value >= 50) & (value < 70)), "low": F.count_if(value < 50)
    }
    shares = {f"{name}_pct": half_even(F.try_divide(n * 100.0, _rows()), 1) for name, n in counts.items()}
    return df.agg(
        _rows().alias("total"), half_even(F.avg(value), 1).alias("avg_score"),
        *[c.alias(name) for name, c in {**counts, **shares}.items()],
    )
