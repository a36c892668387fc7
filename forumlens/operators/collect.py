"""Selecting posts, comments and user histories from landed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens import fixed_values as fixed
from forumlens.functions.lookup import config_table
from forumlens.functions.text import tier_label
from forumlens.operators.ranking import top_n_per_group
from forumlens.schema import COMMENTS

#: Names that are written into a filter; slices of a day of a subreddit in a feed.
PUSHED_NAMES, FEED_SLICES = 500, 8
FLAGS = ["is_self", "is_video", "stickied", "over_18", "spoiler", "locked"]


# ---- projections ---------------------------------------------------------------------------
def author_or_deleted(author: Column) -> Column:
    return F.coalesce(author, F.lit(fixed.DELETED_AUTHOR))


def age_hours(created_utc: Column, as_of: float) -> Column:
    return (F.lit(float(as_of)) - created_utc) / 3600.0


def age_days(created_utc: Column, as_of: float) -> Column:
    """Whole days, rounded down."""
    return F.floor((F.lit(float(as_of)) - created_utc) / 86400.0).cast("bigint")


def _post_fields(as_of: float, permalink_base: str) -> list[Column]:
    created, as_of_time = F.col("created_utc"), F.timestamp_seconds(F.lit(float(as_of)))
    return [
        F.col("id"),
        F.col("title"),
        author_or_deleted(F.col("author")).alias("author"),
        F.col("score"),
        F.col("upvote_ratio"),
        F.col("num_comments"),
        created.cast("double").alias("created_utc"),
        F.timestamp_seconds(created).alias("created_datetime"),
        age_hours(created, as_of).alias("hours_ago"),
        F.col("url"),
        F.concat(F.lit(permalink_base), F.col("permalink")).alias("permalink"),
        F.col("selftext"),
        F.col("domain"),
        F.col("subreddit"),
        F.col("link_flair_text").alias("flair_text"),
        *[F.col(flag) for flag in FLAGS],
        as_of_time.alias("collection_timestamp"),
    ]


def project_posts(
    df: DataFrame, as_of: float, sort_type: str = "new", time_filter: str = "day",
    permalink_base: str = fixed.PERMALINK_BASE, also: Sequence[str] = (),
) -> DataFrame:
    """A landed post in the shape of a listing, and what it has ``also``; the window is recorded for ``top`` only."""
    window = F.lit(time_filter if sort_type == "top" else None).cast("string")
    return df.select(
        *_post_fields(as_of, permalink_base), F.lit(sort_type).alias("sort_type"), window.alias("time_filter"), *also
    )


def project_search_posts(
    df: DataFrame, as_of: float, query: str, sort: str = "relevance", time_filter: str = "all",
    subreddit: str | None = None, permalink_base: str = fixed.PERMALINK_BASE,
) -> DataFrame:
    """A landed post in the shape of a search result: fractional days and four search columns."""
    window = F.lit(time_filter if sort == "top" else None).cast("string")
    return df.select(
        *_post_fields(as_of, permalink_base),
        (age_hours(F.col("created_utc"), as_of) / 24.0).alias("days_ago"),
        F.lit(query).alias("search_query"),
        F.lit(sort).alias("search_sort"),
        window.alias("search_time_filter"),
        F.lit(subreddit).cast("string").alias("search_subreddit"),
    )


def project_comments(df: DataFrame) -> DataFrame:
    """Flat comment rows: ten fields beside the post they belong to, depth 0 where unknown."""
    return df.select(
        "post_id",
        "comment_id",
        "parent_id",
        author_or_deleted(F.col("author")).alias("author"),
        "body",
        "score",
        F.col("created_utc").cast("double").alias("created_utc"),
        F.timestamp_seconds(F.col("created_utc")).alias("created_datetime"),
        "is_submitter",
        "stickied",
        F.coalesce(F.col("depth"), F.lit(0)).cast("int").alias("depth"),
    )


def project_user_comments(
    df: DataFrame, as_of: float, sort_type: str = "new", permalink_base: str = fixed.PERMALINK_BASE
) -> DataFrame:
    """A user's comment with its length, both ages, post fallbacks, and the edit time split from the flag."""
    created = F.col("created_utc")
    edited = F.coalesce(F.col("edited_utc"), F.lit(0.0))
    stamp = F.timestamp_seconds(F.lit(float(as_of)))
    return df.select(
        "comment_id",
        "body",
        F.char_length("body").alias("body_length"),
        "author",
        "score",
        created.cast("double").alias("created_utc"),
        F.date_format(F.timestamp_seconds(created), fixed.USER_TIME_FORMAT).alias("created_datetime"),
        age_hours(created, as_of).alias("hours_ago"),
        age_days(created, as_of).alias("days_ago"),
        F.concat(F.lit(permalink_base), F.col("permalink")).alias("permalink"),
        "subreddit",
        F.coalesce(F.col("post_title"), F.lit(fixed.UNKNOWN_POST_TITLE)).alias("post_title"),
        F.coalesce(F.col("post_id"), F.lit(fixed.UNKNOWN_POST_ID)).alias("post_id"),
        "parent_id",
        "is_submitter",
        "stickied",
        "gilded",
        "controversiality",
        (edited != 0).alias("edited"),
        F.when(edited != 0, edited).alias("edited_utc"),
        F.date_format(stamp, fixed.USER_TIME_FORMAT).alias("collection_timestamp"),
        F.lit(sort_type).alias("sort_type"),
    )


# ---- listings ------------------------------------------------------------------------------
def among(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Rows whose column is one of the names; up to some hundred names reach the scan, more are joined."""
    names = list(dict.fromkeys(names))
    if len(names) <= PUSHED_NAMES:
        return df.where(F.col(column).isin(names))
    wanted = config_table(df.sparkSession, [{column: n} for n in names], f"{column} string")
    return df.join(wanted, column, "left_semi")


def in_window(time_filter: Column, hours_ago: Column) -> Column:
    """Age within hour/day/week/month/year; ``all`` has no bound."""
    bound = F.lit(None).cast("double")
    for name, hours in fixed.LISTING_WINDOW_HOURS.items():
        if hours is not None:
            bound = F.when(time_filter == name, float(hours)).otherwise(bound)
    return bound.isNull() | (hours_ago <= bound)


def filter_posts_by_age(df: DataFrame, max_hours: float = 72) -> DataFrame:
    return df.where(F.col("hours_ago") <= max_hours)


def newest_posts(df: DataFrame, limit: int = 100) -> DataFrame:
    """The ``new`` listing: latest posts of each subreddit."""
    return top_n_per_group(df, ["subreddit"], [F.desc("created_utc"), F.asc("id")], limit)


def top_posts_in_window(df: DataFrame, time_filter: str = "day", limit: int = 100) -> DataFrame:
    """The ``top`` listing: best scored posts of each subreddit inside the window."""
    recent = df.where(in_window(F.lit(time_filter), F.col("hours_ago")))
    return top_n_per_group(recent, ["subreddit"], [F.desc("score"), F.asc("id")], limit)


def collect_subreddit_posts(
    df: DataFrame, subreddit: str, limit: int = 100, sort_type: str = "new", time_filter: str = "day"
) -> DataFrame:
    """One subreddit's listing. ``hot`` and ``rising`` are ranked by the remote service, not here."""
    own = df.where(F.col("subreddit") == subreddit)
    if sort_type == "new":
        return own.orderBy(F.desc("created_utc"), F.asc("id")).limit(limit)
    if sort_type == "top":
        recent = own.where(in_window(F.lit(time_filter), F.col("hours_ago")))
        return recent.orderBy(F.desc("score"), F.asc("id")).limit(limit)
    raise ValueError(f"Invalid sort_type: {sort_type}")


# ---- comments ------------------------------------------------------------------------------
def valid_comments(df: DataFrame, max_age_hours: float | None = None, as_of: float | None = None) -> DataFrame:
    """Without deleted bodies and missing scores; optionally only recent ones."""
    kept = df.where((F.col("body") != fixed.DELETED_BODY) & F.col("score").isNotNull())
    if max_age_hours is not None:
        kept = kept.where(age_hours(F.col("created_utc"), as_of) <= max_age_hours)
    return kept


def top_comments(
    df: DataFrame, max_comments: int = 200, max_age_hours: float | None = None, as_of: float | None = None
) -> DataFrame:
    """Best scored comments of each post, with their rank from 1 as ``comment_rank``."""
    order = [F.desc("score"), F.asc("comment_id")]
    return top_n_per_group(
        valid_comments(df, max_age_hours, as_of), ["post_id"], order, max_comments, rank_name="comment_rank"
    )


def attach_comments(posts: DataFrame, ranked: DataFrame | None) -> DataFrame:
    """Posts with their ranked comments nested in order; an empty list where there are none.

    ``ranked`` comes from :func:`top_comments`, so a list never exceeds its ``max_comments``.
    """
    if ranked is None:
        return posts.withColumns(
            {"comments": F.array().cast(COMMENTS), "comments_collected": F.lit(0).cast("bigint")}
        )
    present = set(ranked.columns)
    fields = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in COMMENTS.elementType.fields
    ]
    lists = ranked.groupBy("post_id").agg(
        F.array_sort(F.collect_list(F.struct("comment_rank", F.struct(*fields).alias("comment")))).alias("_ranked")
    )
    lists = lists.select(F.col("post_id").alias("id"), F.col("_ranked.comment").alias("comments"))
    joined = posts.join(lists, "id", "left")
    comments = F.coalesce(F.col("comments"), F.array().cast(COMMENTS))
    return joined.withColumns({"comments": comments, "comments_collected": F.size(comments).cast("bigint")})


# ---- tiered collection ---------------------------------------------------------------------
def tier_table(spark: SparkSession, tiers: Mapping[str, Mapping] = fixed.TIERS) -> DataFrame:
    """One row per (tier, subreddit) with the tier's limit, window and description."""
    rows = [
        {
            "tier_ord": place, "tier": tier, "subreddit": subreddit, "posts_per_sub": setting["posts_per_sub"],
            "time_filter": setting["time_filter"], "description": setting["description"],
        }
        for place, (tier, setting) in enumerate(tiers.items())
        for subreddit in setting["subreddits"]
    ]
    return config_table(
        spark, rows,
        "tier_ord int, tier string, subreddit string, posts_per_sub bigint, time_filter string, description string",
    )


def write_feed(posts: DataFrame, path: str, mode: str = "append") -> None:
    """Landed posts laid out by day and subreddit, so that listings read the days and subreddits they list."""
    day = F.to_date(F.timestamp_seconds("created_utc"))
    spread = F.pmod(F.xxhash64("id"), F.lit(FEED_SLICES))  # a day of a subreddit that holds a third of all posts is many files
    laid = posts.withColumns({"created_date": day, "_slice": spread}).repartition("created_date", "subreddit", "_slice")
    laid.drop("_slice").write.mode(mode).partitionBy("created_date", "subreddit").parquet(path)


def read_feed(
    spark: SparkSession, path: str, schema: T.StructType, as_of: float, subreddits: list[str] | None = None, time_filter: str = "all"
) -> DataFrame:
    """The posts of a feed that a listing can want: folders of other days and subreddits are not opened."""
    laid = T.StructType([f for f in schema.fields if f.name != "subreddit"]).add("created_date", T.DateType()).add("subreddit", T.StringType())
    feed = spark.read.schema(laid).parquet(path)
    hours = fixed.LISTING_WINDOW_HOURS.get(time_filter)
    if hours is not None:
        feed = feed.where(F.col("created_date") >= F.to_date(F.timestamp_seconds(F.lit(float(as_of - 3600 * hours)))))
    if subreddits is not None:
        feed = among(feed, "subreddit", subreddits)
    return feed.drop("created_date").select(*schema.fieldNames())


def widest_window(windows: Iterable[str]) -> str:
    """The one of several listing windows that holds all others."""
    hours = fixed.LISTING_WINDOW_HOURS
    return max(windows, key=lambda w: float("inf") if hours.get(w) is None else hours[w])


def tiered_listing(spark: SparkSession, path: str, schema: T.StructType, as_of: float, tiers: Mapping[str, Mapping] = fixed.TIERS) -> DataFrame:
    """:func:`tiered_collection` from a feed laid out by :func:`write_feed`, of which it reads what the tiers list."""
    names = [s for setting in tiers.values() for s in setting["subreddits"]]
    window = widest_window(setting["time_filter"] for setting in tiers.values())
    feed = read_feed(spark, path, schema, as_of, names, window)
    return tiered_collection(feed.withColumn("hours_ago", age_hours(F.col("created_utc"), as_of)), tiers)


def tiered_collection(posts: DataFrame, tiers: Mapping[str, Mapping] = fixed.TIERS) -> DataFrame:
    """Each tier's top posts per subreddit, annotated with the tier; limits differ by tier."""
    config = tier_table(posts.sparkSession, tiers).drop("tier_ord").withColumnRenamed("time_filter", "_window")
    matched = posts.join(config, "subreddit").where(in_window(F.col("_window"), F.col("hours_ago")))
    widest = max(setting["posts_per_sub"] for setting in tiers.values())
    order = [F.desc("score"), F.asc("id")]
    kept = top_n_per_group(matched, ["tier", "subreddit"], order, widest, limit_column="posts_per_sub")
    return kept.drop("_window").withColumnsRenamed(
        {"tier": "activity_tier", "description": "tier_description", "posts_per_sub": "target_posts"}
    )


def collection_summary(collected: DataFrame, tiers: Mapping[str, Mapping] = fixed.TIERS) -> DataFrame:
    """Target against actual per tier, tiers without posts included, and the grand total."""
    actual = collected.groupBy(F.col("activity_tier").alias("tier")).agg(F.count(F.lit(1)).alias("actual"))
    config = tier_table(collected.sparkSession, tiers)
    targets = config.groupBy("tier", "description").agg(
        F.countDistinct("subreddit").alias("subs"), F.sum("posts_per_sub").alias("target")
    )
    joined = targets.join(actual, "tier", "left")
    totals = joined.rollup("tier").agg(
        F.sum("subs").alias("subreddits"),
        F.sum("target").alias("target_total"),
        F.sum(F.coalesce("actual", F.lit(0))).alias("actual_total"),
        F.max(F.when(F.col("tier").isNotNull(), F.col("description"))).alias("description"),
        F.grouping("tier").alias("_total"),
    )
    is_total = F.col("_total") == 1
    return totals.select(
        F.when(is_total, "TOTAL").otherwise(F.col("tier")).alias("tier"),
        F.when(is_total, "TOTAL").otherwise(tier_label(F.col("tier"))).alias("label"),
        F.when(~is_total, F.col("description")).alias("description"),
        "subreddits", "target_total", "actual_total",
    )


# ---- user histories ------------------------------------------------------------------------
def drop_removed(df: DataFrame, drop_bodies: tuple[str, ...] = (fixed.DELETED_BODY, fixed.REMOVED_BODY)) -> DataFrame:
    """Without missing authors and deleted or removed bodies."""
    return df.where(F.col("author").isNotNull() & ~F.col("body").isin(*drop_bodies))


def collect_user_comments(df: DataFrame, users: list[str], limit: int = 1000, sort_type: str = "new") -> DataFrame:
    """Each named user's listing, limited first and cleaned after, as the remote listing is."""
    orders = {"new": [F.desc("created_utc"), F.asc("comment_id")], "top": [F.desc("score"), F.asc("comment_id")]}
    if sort_type not in orders:
        raise ValueError(f"Invalid sort_type: {sort_type}")
    own = among(df, "author", users)
    kept = drop_removed(top_n_per_group(own, ["author"], orders[sort_type], limit))
    return kept.withColumn("target_username", F.col("author"))


def user_stats(comments: DataFrame, users: list[str], top: int = 5) -> DataFrame:
    """Totals per target user with a top-subreddit map; users without comments are listed with 0."""
    stats = comments.groupBy("target_username").agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.avg("score").alias("avg_score"),
        F.sum("score").alias("total_score"),
        F.avg(F.char_length("body")).alias("avg_length"),
        F.countDistinct("subreddit").alias("unique_subreddits"),
        F.max("days_ago").alias("oldest_comment_days"),
        F.min("days_ago").alias("newest_comment_days"),
    )
    counts = comments.groupBy("target_username", "subreddit").agg(F.count(F.lit(1)).alias("n"))
    best = top_n_per_group(counts, ["target_username"], [F.desc("n"), F.asc("subreddit")], top, rank_name="place")
    maps = best.groupBy("target_username").agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("place", "subreddit", "n"))),
                lambda e: F.struct(e["subreddit"], e["n"]),
            )
        ).alias("top_subreddits")
    )
    targets = config_table(
        comments.sparkSession, [{"target_username": u} for u in users], "target_username string"
    )
    joined = targets.join(stats, "target_username", "left").join(maps, "target_username", "left")
    return joined.withColumn("total_comments", F.coalesce("total_comments", F.lit(0)))
