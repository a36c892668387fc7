"""Row shapes and the harmonised core every collection is brought to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.functions.numeric import no_nan, number_or_zero

KINDS = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def struct(fields: str) -> T.StructType:
    """A row type from "name kind, ...", without needing a session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


COMMENT = struct(
    "comment_id string, parent_id string, author string, body string, score bigint, created_utc double, "
    "created_datetime timestamp, is_submitter boolean, stickied boolean, depth int"
)
COMMENTS = T.ArrayType(COMMENT)

POST = struct(
    "id string, title string, author string, score bigint, upvote_ratio double, num_comments bigint, "
    "created_utc double, created_datetime timestamp, hours_ago double, url string, permalink string, "
    "selftext string, is_self boolean, domain string, subreddit string, flair_text string, is_video boolean, "
    "stickied boolean, over_18 boolean, spoiler boolean, locked boolean, collection_timestamp timestamp, "
    "sort_type string, time_filter string"
).add("comments", COMMENTS).add("comments_collected", T.LongType())

# The core columns and the default each takes where a collection lacks it.
CORE_COLUMNS: dict[str, tuple[str, object]] = {
    "id": ("string", ""),
    "title": ("string", ""),
    "author": ("string", ""),
    "score": ("bigint", 0),
    "upvote_ratio": ("double", 0.0),
    "num_comments": ("bigint", 0),
    "created_utc": ("double", 0.0),
    "created_datetime": ("timestamp", None),
    "hours_ago": ("double", 0.0),
    "days_ago": ("double", 0.0),
    "url": ("string", ""),
    "permalink": ("string", ""),
    "selftext": ("string", ""),
    "is_self": ("boolean", False),
    "domain": ("string", ""),
    "subreddit": ("string", ""),
    "flair_text": ("string", ""),
    "is_video": ("boolean", False),
    "stickied": ("boolean", False),
    "over_18": ("boolean", False),
    "spoiler": ("boolean", False),
    "locked": ("boolean", False),
    "collection_timestamp": ("string", ""),
    "comments": (COMMENTS.simpleString(), []),
    "comments_collected": ("bigint", 0),
    "search_query": ("string", ""),
    "search_sort": ("string", ""),
    "search_time_filter": ("string", ""),
    "search_subreddit": ("string", ""),
    "found_in_post": ("boolean", False),
    "found_in_comments": ("boolean", False),
    "matched_keywords": ("array<string>", []),
    "broad_search_term": ("string", ""),
    "search_location": ("string", ""),
    "tier": ("string", ""),
    "target_posts": ("bigint", 0),
    "collection_method": ("string", ""),
}


def harmonize_schema(df: DataFrame, days_from_hours: bool = False) -> DataFrame:
    """Every core column present with its type; missing ones take the default, others are kept.

    ``days_ago`` is absent from tiered posts and then defaults to 0, which passes any age limit;
    ``days_from_hours`` derives it instead.
    """
    present = set(df.columns)
    wanted: dict[str, Column] = {}
    for name, (kind, default) in CORE_COLUMNS.items():
        if name == "tier" and "activity_tier" in present:
            tier = F.col("activity_tier")
            if name in present:
                own = F.col("tier").cast("string")
                tier = F.coalesce(F.when(own != "", own), tier)
            wanted[name] = F.coalesce(tier.cast("string"), F.lit(""))
        elif name in present:
            wanted[name] = coerce(df, name, kind)
        elif name == "days_ago" and days_from_hours and "hours_ago" in present:
            wanted[name] = number_or_zero(F.col("hours_ago")) / 24.0
        else:
            wanted[name] = _default(kind, default)
    return df.withColumns(wanted)


def coerce(df: DataFrame, name: str, kind: str) -> Column:
    """A present column brought to its core type: bad numbers 0, null flags false, null text empty."""
    column, actual = F.col(name), df.schema[name].dataType
    if kind == "bigint":
        if isinstance(actual, T.IntegralType):
            return F.coalesce(column.cast("bigint"), F.lit(0).cast("bigint"))
        return F.coalesce(number_or_zero(column).try_cast("bigint"), F.lit(0).cast("bigint"))
    if kind == "double":
        return number_or_zero(column)
    if kind == "boolean":
        if isinstance(actual, T.BooleanType):
            return F.coalesce(column, F.lit(False))
        if isinstance(actual, T.StringType):
            return F.coalesce(column.try_cast("boolean"), F.lit(False))
        return F.coalesce(no_nan(column.try_cast("double")) != 0, F.lit(False))
    if kind == "timestamp":
        return F.try_to_timestamp(column) if isinstance(actual, T.StringType) else column.cast("timestamp")
    if kind.startswith("array"):
        if isinstance(actual, T.ArrayType):
            return F.coalesce(column, F.array().cast(actual))
        return F.array().cast(kind)
    return F.coalesce(column.cast("string"), F.lit(""))


def _default(kind: str, default: object) -> Column:
    if isinstance(default, list):
        return F.array().cast(kind)
    return F.lit(default).cast(kind)
