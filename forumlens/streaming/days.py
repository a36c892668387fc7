"""Posts per subreddit and day from a feed whose posts may land late: partial sums, closing days, corrections, compaction.

Each batch is summed by itself and appended as a version of a few rows; a day's count is the sum over the versions, so
there is no state to keep or to expire. The newest post so far, less a delay, closes days. A post of a closed day
still counts: its version re-opens the day, and ``late_posts`` says how many such there were. Every so many
batches the versions are folded into monthly tables, of which only the months they touch are written anew.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.session import delete_folder, list_folder, path_exists, publish, read_published
from forumlens.streaming.feeds import drain

DELAY = "2 days"
FOLD_EVERY = 16
SUMS = "day timestamp, subreddit string, posts bigint, total_score bigint, late_posts bigint"


def _added(sums: DataFrame) -> DataFrame:
    return sums.groupBy("day", "subreddit").agg(*[F.sum(c).alias(c) for c in ("posts", "total_score", "late_posts")])


def _newest(spark: SparkSession, path: str, version: int) -> str | None:
    """The time of the newest post up to a batch."""
    place = f"{path}/newest/{version}"
    return (read_published(spark, place) or None) if version >= 0 and path_exists(spark, place) else None


def _closed(day: Column, newest: str | None, delay: str) -> Column:
    """Whether a day was over for as long as the delay when the newest post was written."""
    return F.lit(False) if newest is None else day + F.expr("interval 1 day") + F.expr(f"interval {delay}") <= F.lit(newest).cast("timestamp")


def count_days(
    posts: DataFrame, path: str, checkpoint: str, created: str = "created_datetime", delay: str = DELAY, fold_every: int = FOLD_EVERY
) -> DataFrame:
    """Take up what has landed, and read the table; see :func:`read_days`.

    A batch that comes twice after a failure writes the same version again. Posts without a time are counted under
    a null day, which never closes.
    """
    spark = posts.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        before = _newest(spark, path, batch_id - 1)
        day = F.date_trunc("day", F.col(created))
        sums = batch.groupBy(day.alias("day"), "subreddit").agg(
            F.count(F.lit(1)).alias("posts"), F.sum("score").cast("bigint").alias("total_score"),
            F.count_if(F.coalesce(_closed(day, before, delay), F.lit(False))).alias("late_posts"), F.max(created).alias("_newest"),
        )
        own = f"{path}/versions/version={batch_id}"
        sums.write.mode("overwrite").parquet(own)
        latest = spark.read.parquet(own).agg(F.greatest(F.max("_newest"), F.lit(before).cast("timestamp")).cast("string")).first()[0]
        publish(spark, f"{path}/newest/{batch_id}", latest or "")
        if (batch_id + 1) % fold_every == 0:
            fold_versions(spark, path, batch_id, fold_every)

    drain(posts, checkpoint, write)
    return read_days(spark, path, delay)


# ---- reading -------------------------------------------------------------------------------
def _numbers(spark: SparkSession, folder: str) -> list[int]:
    if not path_exists(spark, folder):
        return []
    names = [p.rsplit("/", 1)[-1].rsplit("=", 1)[-1] for p in list_folder(spark, folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _folded(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, dict[str, int]]:
    """The last batch that is folded in, and the batch at which each month was last written."""
    steps = [n for n in _numbers(spark, f"{path}/months") if before is None or n < before]
    return (steps[-1], json.loads(read_published(spark, f"{path}/months/{steps[-1]}"))) if steps else (-1, {})


def _months(spark: SparkSession, path: str, months: dict[str, int]) -> DataFrame:
    paths = [f"{path}/folded/{at}/month={month}" for month, at in sorted(months.items())]
    return spark.read.schema(SUMS).parquet(*paths) if paths else spark.createDataFrame([], SUMS)


def _versions(spark: SparkSession, path: str, after: int, until: int | None = None) -> DataFrame:
    wanted = [n for n in _numbers(spark, f"{path}/versions") if n > after and (until is None or n <= until)]
    paths = [f"{path}/versions/version={n}" for n in wanted]
    return spark.read.schema(SUMS).parquet(*paths) if paths else spark.createDataFrame([], SUMS)


def read_days(spark: SparkSession, path: str, delay: str = DELAY) -> DataFrame:
    """``day``, ``subreddit``, ``posts``, ``total_score``, ``late_posts`` (landed after the day closed), ``closed``."""
    at, months = _folded(spark, path)
    newest = [n for n in _numbers(spark, f"{path}/newest")][-1:]
    closed = _closed(F.col("day"), _newest(spark, path, newest[0]) if newest else None, delay)
    whole = _added(_months(spark, path, months).unionByName(_versions(spark, path, at)))
    return whole.withColumn("closed", F.coalesce(closed, F.lit(False)))


# ---- folding -------------------------------------------------------------------------------
def fold_versions(spark: SparkSession, path: str, until: int, keep: int = FOLD_EVERY) -> None:
    """Add the versions up to a batch to the months they touch, and publish which tables count from now on.

    What the list before this one still reads is left until the next fold, for readers that hold it.
    """
    if path_exists(spark, f"{path}/months/{until}"):
        return
    at, months = _folded(spark, path)
    month = F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("none"))
    new = _added(_versions(spark, path, at, until)).withColumn("month", month)
    touched = [r["month"] for r in new.select("month").distinct().collect()]
    old = _months(spark, path, {m: n for m, n in months.items() if m in touched}).withColumn("month", month)
    merged = _added(new.unionByName(old).drop("month")).withColumn("month", month)
    merged.write.mode("overwrite").partitionBy("month").parquet(f"{path}/folded/{until}")
    _, replaced = _folded(spark, path, before=at) if at >= 0 else (-1, {})
    publish(spark, f"{path}/months/{until}", json.dumps({**months, **dict.fromkeys(touched, until)}))
    for version in [n for n in _numbers(spark, f"{path}/versions") if n <= at]:
        delete_folder(spark, f"{path}/versions/version={version}")
    for name in [n for n in _numbers(spark, f"{path}/newest") if n < until - 1]:
        delete_folder(spark, f"{path}/newest/{name}")
    for m, n in replaced.items():
        if months.get(m) != n:
            delete_folder(spark, f"{path}/folded/{n}/month={m}")
