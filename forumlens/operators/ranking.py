"""Top-n per group, keep-first dedupe, and the sort orders of the outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_SLICES = 64


def top_n_per_group(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    n: int,
    limit_column: str | None = None,
    rank_name: str | None = None,
    slices: int = RANK_SLICES,
) -> DataFrame:
    """The first ``n`` rows of each group under a total order.

    Spark cuts each input partition to n rows per group before it shuffles. A group that fills many
    partitions would still send n rows from each of them to one task, so the input partitions are
    first ranked in ``slices`` separate sets; the second ranking sees at most slices * n rows per
    group. The result does not depend on how rows fall into slices. ``limit_column`` holds a
    smaller limit per row; the literal ``n`` stays beside it, since only a literal is pushed down.
    """
    rank = rank_name or "_rank"
    sliced = df.withColumn("_slice", F.spark_partition_id() % F.lit(slices))
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    survivors = sliced.withColumn("_slice_rank", F.row_number().over(within)).where(F.col("_slice_rank") <= n)
    whole = Window.partitionBy(*keys).orderBy(*order)
    ranked = survivors.drop("_slice", "_slice_rank").withColumn(rank, F.row_number().over(whole))
    ranked = ranked.where(F.col(rank) <= n)
    if limit_column:
        ranked = ranked.where(F.col(rank) <= F.col(limit_column))
    return ranked if rank_name else ranked.drop(rank)


def _blank(id_column: str) -> Column:
    return F.coalesce(F.trim(F.col(id_column)), F.lit("")) == ""


def dedupe_posts(df: DataFrame, order: list[str], id_column: str = "id") -> DataFrame:
    """One row per id, the first in ``order``. Rows with a blank id are no duplicates of each other.

    Each input partition keeps one row per id before the shuffle, so an id copied into a third of
    all rows sends one row per partition. A blank id is widened by the row's own position, which
    keeps those rows apart and spreads them.
    """
    place = F.when(_blank(id_column), F.monotonically_increasing_id())
    keyed = df.withColumn("_place", place)
    first = Window.partitionBy(id_column, "_place").orderBy(*[F.col(c).asc() for c in order])
    ranked = keyed.withColumn("_row", F.row_number().over(first))
    return ranked.where(F.col("_row") == 1).drop("_row", "_place")


def duplicate_count(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows, rows that :func:`dedupe_posts` keeps, and the difference."""
    blank = _blank(id_column)
    total, distinct = F.count(F.lit(1)), F.countDistinct(F.when(~blank, F.col(id_column))) + F.count_if(blank)
    return df.agg(total.alias("total_rows"), distinct.alias("unique_rows"), (total - distinct).alias("duplicates"))


def sentiment_order(label: Column) -> Column:
    """positive 3, neutral 2, negative 1; anything else ranks as neutral."""
    return F.when(label == "positive", 3).when(label == "negative", 1).otherwise(2)


def final_sort(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Relevance, sentiment class, engagement, score (all descending), then age; absent keys skipped."""
    present = set(df.columns)
    order = []
    if "relevance_score" in present:
        order.append(F.col("relevance_score").desc_nulls_last())
    if "overall_sentiment_class" in present:
        order.append(sentiment_order(F.col("overall_sentiment_class")).desc())
    order += [F.col(c).desc_nulls_last() for c in ("engagement_score", "score") if c in present]
    age = next((c for c in ("hours_ago", "days_ago") if c in present), None)
    if age:
        order.append(F.col(age).asc_nulls_last())
    return df.orderBy(*order, F.col(id_column).asc())
