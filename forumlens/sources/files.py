"""Reading and writing posts as CSV, JSON and parquet.

CSV is the exchange format: every field quoted, quotes doubled, backslashes doubled, comments as
JSON text. A quoted field may hold line breaks, so Spark reads one CSV file in one task; parquet is
the format for data of any size, and the default of every sink here.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens import fixed_values as fixed
from forumlens.schema import COMMENT, COMMENTS, POST, harmonize_schema
from forumlens.session import list_folder
from forumlens.sources.comments_json import decode_comments, repair_comments
from forumlens.sources.json_arrays import read_arrays

CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
CSV_WRITING = {
    "header": "true", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
ASCII_JSON = {"writeNonAsciiCharacterAsCodePoint": "true"}
TIME_COLUMNS = ("created_datetime", "collection_timestamp")
POSITION = "row_order"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


# ---- reading -------------------------------------------------------------------------------
def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All columns as text, named by the header, backslashes single again. Files must share a layout."""
    raw = spark.read.options(**CSV_DIALECT).csv(paths)
    return raw.select(*[F.replace(F.col(c), F.lit("\\\\"), F.lit("\\")).alias(c) for c in raw.columns])


def with_types(df: DataFrame, schema: T.StructType = POST) -> DataFrame:
    """Text columns cast to the types the schema names; bad values become null, others stay text."""
    types = {f.name: f.dataType for f in schema.fields}

    def typed(name: str) -> Column:
        kind = types.get(name)
        if kind is None or isinstance(kind, T.ArrayType):
            return F.col(name)
        if isinstance(kind, T.TimestampType):
            return F.try_to_timestamp(F.col(name)).alias(name)
        if isinstance(kind, T.LongType):
            return F.coalesce(F.col(name).try_cast("bigint"), F.col(name).try_cast("double").try_cast("bigint")).alias(name)
        return F.col(name).try_cast(kind).alias(name)

    return df.select(*[typed(c) for c in df.columns])


def read_posts_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Posts from CSV, typed, their comments decoded, damaged ones repaired where a way is known."""
    raw = with_position(spark.read.options(**CSV_DIALECT).csv(paths))
    texts = [c for c in raw.columns if c != POSITION]
    single = [F.replace(F.col(c), F.lit("\\\\"), F.lit("\\")).alias(c) for c in texts]
    df = with_types(raw.select(*single, POSITION))
    return df.withColumn("comments", repair_comments(F.col("comments"))) if "comments" in df.columns else df


def one_record_per_line(spark: SparkSession, paths: str | list[str]) -> bool:
    """Whether the first line that isn't blank is a whole JSON value; one line is read."""
    first = spark.read.text(paths).where("trim(value) <> ''").limit(1)
    found = first.select(F.try_parse_json("value").isNotNull()).first()
    return found is None or bool(found[0])


def read_posts_json(spark: SparkSession, paths: str | list[str], schema: T.StructType = POST, lines: bool | None = None) -> DataFrame:
    """Posts from JSON with every field the records have; those that ``schema`` names get its types.

    Files hold one record, or one array of records, per line, which Spark can split; or one array over several lines, as
    a plain dump with indents leaves it, which :func:`read_arrays` cuts into records. Unless ``lines`` says which, the first
    line decides. A record that isn't JSON raises.
    """
    lines = one_record_per_line(spark, paths) if lines is None else lines
    raw = spark.read.option("mode", "FAILFAST").json(paths) if lines else read_arrays(spark, paths, POSITION)
    if not raw.columns:
        return spark.createDataFrame([], schema)
    df = with_types(with_position(raw) if lines else raw, schema)
    return df.withColumn("comments", _as_comments(df)) if "comments" in df.columns else df


def _as_comments(df: DataFrame) -> Column:
    """Comments of any inferred shape as a list of comments; what has another shape is no comment."""
    kind = df.schema["comments"].dataType
    if isinstance(kind, T.StringType):
        return repair_comments(F.col("comments"))
    none = F.array().cast(COMMENTS)
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        return none
    present = set(kind.elementType.fieldNames())

    def typed(comment: Column) -> Column:
        value = lambda f: comment[f.name].try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        return F.struct(*[value(f).alias(f.name) for f in COMMENT.fields])

    return F.coalesce(F.transform("comments", typed), none)


def with_position(df: DataFrame) -> DataFrame:
    """Adds ``row_order``: the file a row was read from, the part of the file, and its place there.

    Rows of a file are in its order under it, however Spark splits the file or packs files into tasks.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
    return df.select("*", place.alias(POSITION))


def load_posts(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """Posts from a path by its extension, on request with :func:`with_position`; a missing file raises."""
    if path.endswith(".csv"):
        df = parse_times(read_posts_csv(spark, path))
    elif path.endswith(".json"):
        df = parse_times(read_posts_json(spark, path))
    elif path.endswith(".parquet"):
        df = with_position(spark.read.parquet(path))
    else:
        raise ValueError("File must be CSV, JSON or parquet")
    return df if position else df.drop(POSITION)


def parse_times(df: DataFrame) -> DataFrame:
    """Time columns that are present, as timestamps; text that is no time becomes null."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in TIME_COLUMNS if c in df.columns})


def raw_files(paths: list[str]) -> list[str]:
    """Collected files by name, each once, without results of an earlier analysis."""
    wanted = re.compile("|".join(fixed.DAILY_FILES + fixed.SEARCH_FILES))
    named = [p for p in dict.fromkeys(paths) if wanted.search(p.rsplit("/", 1)[-1])]
    return [p for p in named if "_analyzed_" not in p.rsplit("/", 1)[-1]]


def find_raw_files(spark: SparkSession, folder: str, forms: tuple[str, ...] = (".csv", ".json", ".parquet")) -> list[str]:
    """Collected files that lie in a folder, on any file system Spark reads: daily ones first, then searches, each by name."""
    daily = re.compile("|".join(fixed.DAILY_FILES))
    found = raw_files([path for path in list_folder(spark, folder) if path.endswith(forms)])
    return sorted(found, key=lambda p: (not daily.search(p.rsplit("/", 1)[-1]), p))


def collection_type(path: Column) -> Column:
    lowered = F.lower(path)
    return (
        F.when(lowered.contains("search") | lowered.contains("data_tools"), "keyword_search")
        .when(lowered.contains("daily") | lowered.contains("activity_based"), "daily_subreddits")
        .otherwise("unknown")
    )


def tag_provenance(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Adds source_file and collection_type from the path each row was read from."""
    path = F.col("_metadata.file_path") if path is None else path
    return df.withColumns({"source_file": F.element_at(F.split(path, "/"), -1), "collection_type": collection_type(path)})


def combine_collections(frames: list[DataFrame]) -> DataFrame:
    """Harmonised union by name; ``file_order`` keeps the order the frames are given in."""
    ordered = [harmonize_schema(df).withColumn("file_order", F.lit(i)) for i, df in enumerate(frames, start=1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ordered)


def load_collections(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files as one frame in file order, tagged with where each row comes from.

    ``file_order`` and ``row_order`` are the order of the rows, the same for any size of splits.
    """
    frames = [tag_provenance(load_posts(spark, path, position=True), F.lit(path)) for path in dict.fromkeys(paths)]
    return combine_collections(frames)


# ---- quality -------------------------------------------------------------------------------
def decode_quality(df: DataFrame, raw: str = "comments") -> DataFrame:
    """Rows with no comments before and after decoding; a difference means text that did not parse."""
    text = F.coalesce(F.col(raw), F.lit(""))
    decoded = F.size(decode_comments(F.col(raw)))
    return df.agg(
        F.count(F.lit(1)).alias("total_posts"), F.count_if(text.isin("", "[]")).alias("empty_before"),
        F.count_if(decoded == 0).alias("empty_after"),
    )


# ---- writing -------------------------------------------------------------------------------
def as_text(df: DataFrame) -> DataFrame:
    """Nested columns as compact ASCII JSON and times in ISO form, for formats without types."""

    def written(field: T.StructField) -> Column:
        kind, column = field.dataType, F.col(field.name)
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(column, ASCII_JSON).alias(field.name)
        if isinstance(kind, T.TimestampType):
            return F.date_format(column, ISO_FORMAT).alias(field.name)
        return column

    return df.select(*[written(f) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    text = as_text(df)
    doubled = [
        F.replace(F.col(f.name), F.lit("\\"), F.lit("\\\\")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in text.schema.fields
    ]
    writer = text.select(*doubled).write.options(**CSV_WRITING)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_posts_json(df: DataFrame, path: str) -> None:
    """One record per line, comments nested."""
    df.write.option("ignoreNullFields", False).json(path)


def write_by_user(df: DataFrame, path: str) -> None:
    """One folder per target user."""
    write_csv(df, path, ["target_username"])


def write_analysis(df: DataFrame, path: str, form: str = "parquet") -> str:
    """The analysed posts as parquet, csv or json; times in json are plain text to the second."""
    if form == "parquet":
        df.write.parquet(path)
    elif form == "csv":
        write_csv(df, path)
    elif form == "json":
        times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
        write_posts_json(df.withColumns({c: F.date_format(c, fixed.REPORT_TIME_FORMAT) for c in times}), path)
    else:
        raise ValueError(f"unknown form: {form}")
    return path


def read_landed(spark: SparkSession, path: str, schema: T.StructType, created_after: str | None = None) -> DataFrame:
    """A landed feed, partitioned by ``created_date``; a start date prunes whole folders."""
    df = spark.read.schema(schema).parquet(path)
    return df if created_after is None else df.where(F.col("created_date") >= F.lit(created_after).cast("date"))


__all__ = [
    "COMMENTS", "as_text", "collection_type", "combine_collections", "decode_quality", "find_raw_files", "load_collections",
    "load_posts", "one_record_per_line", "parse_times", "raw_files", "read_csv", "read_landed", "read_posts_csv", "read_posts_json", "tag_provenance",
    "with_position", "with_types", "write_analysis", "write_by_user", "write_csv", "write_posts_json",
]
