"""Reading and writing: each query sends the given tables through a format and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.catalog.analytics import BRIEF, GATED_SQL, engaged
from forumlens.catalog.base import Views, query
from forumlens.catalog.collecting import USERS_SQL, target_comments
from forumlens.operators.ranking import dedupe_posts
from forumlens.schema import POST
from forumlens.session import work_folder
from forumlens.sources import files
from forumlens.sources.comments_json import decode_comments, repair_comments

ROUND_TRIP = (
    "select p.id, title, selftext, score, upvote_ratio, hours_ago, cast(created_utc as double) as created_utc,"
    " strftime(to_timestamp(p.created_utc) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as created_datetime,"
    " coalesce(string_agg(c.body, '|' order by comment_rank), '') as bodies, coalesce(cast(sum(c.score) as bigint), 0) as comment_score"
    " from (select id, coalesce(title, '') as title, coalesce(selftext, '') as selftext, score, upvote_ratio, hours_ago, created_utc"
    " from posts) p left join (select post_id, body, score, comment_rank from ranked_comments) c on p.id = c.post_id group by all"
).replace("p.id, title, selftext, score,", "p.id, title, selftext, p.score,")


def stored(v: Views) -> DataFrame:
    """Posts with comments and times, as a collection is stored."""
    return v.nested().withColumns(
        {"created_datetime": F.timestamp_seconds("created_utc"), "created_utc": F.col("created_utc").cast("double")}
    )


def brief(df: DataFrame) -> DataFrame:
    bodies = F.array_join(F.transform("comments", lambda c: c["body"]), "|")
    total = F.aggregate("comments", F.lit(0).cast("bigint"), lambda a, c: a + c["score"])
    return df.select(
        "id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("selftext", F.lit("")).alias("selftext"), "score",
        "upvote_ratio", "hours_ago", "created_utc", F.date_format("created_datetime", "yyyy-MM-dd HH:mm:ss").alias("created_datetime"),
        bodies.alias("bodies"), total.alias("comment_score"),
    )


def csv_folder(v: Views, name: str = "posts") -> str:
    path = work_folder(v.spark, name)
    files.write_csv(stored(v), path)
    return path


@query("read_posts_csv", ROUND_TRIP)
def read_posts_csv(v: Views) -> DataFrame:
    return brief(files.read_posts_csv(v.spark, csv_folder(v)))


@query(
    "write_posts_csv",
    "select id, '\"' || replace(coalesce(title, ''), '\"', '\"\"') || '\"' as title_field from posts",
)
def write_posts_csv(v: Views) -> DataFrame:
    """What stands in the file for each title: quoted, quotes doubled; titles hold no line breaks."""
    path = work_folder(v.spark, "titles")
    files.write_csv(v.posts().select("id", F.coalesce("title", F.lit("")).alias("title")), path)
    lines = v.spark.read.option("pathGlobFilter", "*.csv").text(path)
    rows = lines.where(F.col("value") != '"id","title"')
    parts = F.regexp_extract("value", r'^"(\d+)",(".*")$', 1), F.regexp_extract("value", r'^"(\d+)",(".*")$', 2)
    return rows.select(parts[0].alias("id"), F.replace(parts[1], F.lit("\\\\"), F.lit("\\")).alias("title_field"))


@query("read_posts_json", ROUND_TRIP)
def read_posts_json(v: Views) -> DataFrame:
    """Arrays over several lines, indented, as the collectors leave them; the reader finds the form itself."""
    path = f"{work_folder(v.spark, 'array')}.json"
    record = F.concat(F.lit("  {\n"), *_indented(stored(v)), F.lit("  }"))
    opened = F.when(F.row_number().over(Window.partitionBy("part").orderBy("id")) == 1, "[\n").otherwise(",\n")
    closed = F.when(F.row_number().over(Window.partitionBy("part").orderBy(F.desc("id"))) == 1, "\n]").otherwise("")
    parts = stored(v).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(8))).withColumn("value", record)
    lines = parts.withColumns({"value": F.concat(opened, "value", closed)}).repartition("part").sortWithinPartitions("part", "id")
    lines.select("part", "value").write.partitionBy("part").option("lineSep", "\n").text(path)
    return brief(files.load_posts(v.spark, path))


def _indented(df: DataFrame) -> list:
    """The fields of a record, a line each."""
    fields = []
    for i, f in enumerate(df.schema.fields):
        field = F.to_json(F.struct(f.name), {**files.ASCII_JSON, "ignoreNullFields": "false"})
        fields += [F.lit("    "), F.substring(field, F.lit(2), F.length(field) - 2), F.lit(",\n" if i + 1 < len(df.columns) else "\n")]
    return fields


@query("write_posts_json", ROUND_TRIP)
def write_posts_json(v: Views) -> DataFrame:
    path = work_folder(v.spark, "lines")
    files.write_posts_json(stored(v), path)
    return brief(files.read_posts_json(v.spark, path, lines=True))


def comment_texts(v: Views) -> DataFrame:
    """Comments as text: sound JSON for most posts, and for some what a damaged file holds."""
    text = F.to_json("comments", files.ASCII_JSON)
    python = F.regexp_replace(F.regexp_replace(text, r'(?<!\\)":true', '":True'), r'(?<!\\)":false', '":False')
    python = F.replace(python, F.lit("null"), F.lit("None"))
    number = F.col("id").cast("bigint")
    damaged = (
        F.when(number % 10 == 1, F.replace(text, F.lit('"'), F.lit('""')))
        .when(number % 10 == 2, python)
        .when(number % 10 == 3, F.lit("[{broken"))
        .when(number % 10 == 4, F.lit(""))
        .otherwise(text)
    )
    return v.nested().select("id", text.alias("sound"), damaged.alias("damaged"))


DECODED_SQL = (
    "select p.id, count(c.comment_id) as n, coalesce(string_agg(c.body, '|' order by comment_rank), '') as bodies from posts p"
    " left join ranked_comments c on p.id = c.post_id {extra} group by 1"
)


def decoded(df: DataFrame, comments) -> DataFrame:
    listed = df.select("id", comments.alias("comments"))
    return listed.select(
        "id", F.size("comments").cast("bigint").alias("n"), F.array_join(F.transform("comments", lambda c: c["body"]), "|").alias("bodies")
    )


@query("decode_comments", DECODED_SQL.format(extra=""))
def decode(v: Views) -> DataFrame:
    return decoded(comment_texts(v), decode_comments(F.col("sound")))


@query("repair_comments", DECODED_SQL.format(extra="and cast(p.id as bigint) % 10 not in (3, 4)"))
def repair(v: Views) -> DataFrame:
    return decoded(comment_texts(v), repair_comments(F.col("damaged")))


@query(
    "decode_quality",
    "select count(*) as total_posts, count(*) filter (n = 0 and m <> 3 or m = 4) as empty_before,"
    " count(*) filter (n = 0 or m in (3, 4)) as empty_after from"
    " (select p.id, any_value(cast(p.id as bigint) % 10) as m, count(c.comment_id) as n from posts p"
    " left join ranked_comments c on p.id = c.post_id group by 1)",
)
def quality(v: Views) -> DataFrame:
    number = F.col("id").cast("bigint") % 10
    mixed = comment_texts(v).withColumn("comments", F.when(number.isin(3, 4), F.col("damaged")).otherwise(F.col("sound")))
    return files.decode_quality(mixed)


def _collections(v: Views) -> list[str]:
    """Two collections and an earlier result, as folders named the way collectors name files."""
    base = work_folder(v.spark, "landed")
    parts = ["activity_based_1", "data_tools_hybrid_search_1", "daily_analyzed_1"]
    for name in parts:
        v.posts().write.parquet(f"{base}/{name}.parquet")
    return [f"{base}/{name}.parquet" for name in parts]


COLLECTIONS_SQL = (
    "select id, 'daily_subreddits' as collection_type, 'activity_based_1.parquet' as source_file from posts"
    " union all select id, 'keyword_search', 'data_tools_hybrid_search_1.parquet' from posts"
)


@query("scan_raw_files", COLLECTIONS_SQL)
def scan_raw_files(v: Views) -> DataFrame:
    """What lies in a folder, without the earlier result."""
    folder = _collections(v)[0].rsplit("/", 1)[0]
    return files.load_collections(v.spark, files.find_raw_files(v.spark, folder)).select("id", "collection_type", "source_file")


KEPT_SQL = (
    "select id, source_file, title from (select id, source_file, title, row_number() over (partition by id order by source_file, version) as place from ("
    "select id, 'activity_based_1.json' as source_file, 1 as version, 'first ' || title as title from posts"
    " union all select id, 'activity_based_1.json', 2, 'again ' || title from posts where cast(id as bigint) % 2 = 0"
    " union all select id || 'x', 'search_1.csv', 1, title from posts union all select id, 'search_1.csv', 1, 'third' from posts)) where place = 1"
)


@query("dedupe_files", KEPT_SQL)
def dedupe_files(v: Views) -> DataFrame:
    """Of each id the first row of the first file is kept, however the files are split."""
    folder = work_folder(v.spark, "in-order")
    posts = v.posts().select("id", "title")
    first = posts.select("id", F.concat(F.lit("first "), "title").alias("title"), F.lit(1).alias("version"))
    again = posts.where(F.col("id").cast("bigint") % 2 == 0).select("id", F.concat(F.lit("again "), "title").alias("title"), F.lit(2).alias("version"))
    ordered = first.unionByName(again).repartition(4, "id").sortWithinPartitions("version", "id").drop("version")
    ordered.write.json(f"{folder}/activity_based_1.json")
    third = posts.select(F.concat("id", F.lit("x")).alias("id"), "title").unionByName(posts.select("id", F.lit("third").alias("title")))
    files.write_csv(third, f"{folder}/search_1.csv")
    united = files.load_collections(v.spark, files.find_raw_files(v.spark, folder))
    kept = dedupe_posts(united, ["file_order", files.POSITION])
    return kept.select("id", "source_file", "title")


@query("tag_provenance", COLLECTIONS_SQL)
def tag_provenance(v: Views) -> DataFrame:
    """The same from the path each row was read from, in one scan."""
    paths = files.raw_files(_collections(v))
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    tagged = files.tag_provenance(v.spark.read.parquet(*paths), F.concat(F.lit("/"), folder))
    return tagged.select("id", "collection_type", "source_file")


@query("write_analysis", f"select {BRIEF} from engaged", GATED_SQL)
def write_analysis(v: Views) -> DataFrame:
    """The analysed table as parquet, csv and json, read back from all three."""
    columns = BRIEF.split(", ")
    base, frame = work_folder(v.spark, "analysis"), engaged(v).select(*columns)
    stored_at = {form: files.write_analysis(frame, f"{base}/{form}", form) for form in ("parquet", "csv", "json")}
    kept = v.spark.read.parquet(stored_at["parquet"])
    plain = files.with_types(files.read_csv(v.spark, stored_at["csv"]), kept.schema).select(*columns)
    lines = v.spark.read.schema(kept.schema).json(stored_at["json"])
    # A row stays only if all three agree on it.
    return kept.intersect(plain).intersect(lines)


@query("write_by_user", "select target_username, comment_id, body, score from target_comments", USERS_SQL)
def write_by_user(v: Views) -> DataFrame:
    path = work_folder(v.spark, "by-user")
    files.write_by_user(target_comments(v).select("target_username", "comment_id", "body", "score"), path)
    back = files.read_csv(v.spark, path)
    return back.select("target_username", "comment_id", "body", F.col("score").cast("bigint").alias("score"))


@query("landed_posts", "select id, subreddit, score from posts where created_utc >= 1705276800")
def landed_posts(v: Views) -> DataFrame:
    """A feed partitioned by day; the start date prunes folders."""
    path = work_folder(v.spark, "feed")
    day = F.to_date(F.timestamp_seconds("created_utc"))
    v.posts().select("id", "subreddit", "score", day.alias("created_date")).write.partitionBy("created_date").parquet(path)
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id string, subreddit string, score bigint, created_date date")
    return files.read_landed(v.spark, path, schema, "2024-01-15").select("id", "subreddit", "score")


