"""Formats, damaged comments, landed feeds and resumed streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from forumlens.operators.ranking import dedupe_posts, duplicate_count
from forumlens.schema import COMMENT, POST, coerce
from forumlens.session import list_folder, publish, settings, work_folder
from forumlens.sources import files
from forumlens.sources.comments_json import repair_comments
from forumlens.streaming import days, feeds

BODIES = ['he said "hi"', "", "ends with a backslash \\", "two\nlines\r\nthree", "café — naïve 😀", "\\n literal", '"', "comma, 'quote'", " blanks "]


def comment(body):
    return {**{f.name: None for f in COMMENT.fields}, "comment_id": "c", "body": body, "score": 1}


def test_csv_round_trip(spark):
    rows = [(str(i), b, b, [comment(b) for b in BODIES], dt.datetime(2024, 1, 2, 3, 4, 5)) for i, b in enumerate(BODIES)]
    schema = "id string, title string, selftext string, comments " + POST["comments"].dataType.simpleString() + ", created_datetime timestamp"
    path = work_folder(spark, "csv")
    files.write_csv(spark.createDataFrame(rows, schema), path)
    back = {r["id"]: r for r in files.read_posts_csv(spark, path).collect()}
    for i, b in enumerate(BODIES):
        got = back[str(i)]
        assert (got["title"] or "") == b and [c["body"] for c in got["comments"]] == BODIES
        assert got["created_datetime"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_repair_chain(spark):
    sound = json.dumps([comment('a "quoted" word'), comment("")])
    cases = {
        "sound": (sound, 2), "doubled": (json.dumps([comment("plain")]).replace('"', '""'), 1),
        "literal": (str([comment("it's"), comment('say "x"')]), 2), "empty": ("", 0), "list": ("[]", 0), "broken": ("[{'a':", 0),
        "text": ("nothing", 0), "none": (None, 0), "code": ("[__import__('os').getcwd()]", 0),
    }
    df = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "k string, t string")
    got = {r["k"]: r["c"] for r in df.select("k", repair_comments(F.col("t")).alias("c")).collect()}
    assert {k: len(c) for k, c in got.items()} == {k: n for k, (_, n) in cases.items()}
    assert [c["body"] for c in got["literal"]] == ["it's", 'say "x"']


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "posts.json"
    path.write_text(json.dumps([{"id": "1", "title": "x", "comments": [comment("b")]}, {"id": "2"}]))
    rows = {r["id"]: r for r in files.load_posts(spark, str(path)).collect()}
    assert rows["1"]["comments"][0]["body"] == "b" and rows["2"]["title"] is None


def test_unknown_extension_and_missing_file(spark):
    with pytest.raises(ValueError):
        files.load_posts(spark, "posts.xml")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.load_posts(spark, "/nowhere/posts.csv").count()


def test_raw_files():
    paths = ["a/daily_1.csv", "a/x_search_2.csv", "a/daily_analyzed_1.csv", "a/notes.csv", "a/daily_1.csv", "a/daily_search.csv"]
    assert files.raw_files(paths) == ["a/daily_1.csv", "a/x_search_2.csv", "a/daily_search.csv"]


def test_stream_takes_up_only_what_is_new(spark):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))
    schema = spark.range(0).schema
    sizes = []
    for low, high in ((0, 5), (5, 8), (8, 8)):
        spark.range(low, high).write.mode("append").parquet(landing)
        sizes.append(feeds.run_to_table(feeds.landed_stream(spark, landing, schema), path, checkpoint).count())
    assert sizes == [5, 8, 8]


def test_stream_dedupe_over_batches(spark):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))
    posts = spark.range(6).selectExpr("cast(id % 3 as string) id", "timestamp_seconds(1706659200 + id * 3600) created_datetime")
    for _ in range(2):
        posts.write.mode("append").parquet(landing)
        kept = feeds.stream_dedupe(feeds.landed_stream(spark, landing, posts.schema), path, checkpoint)
    assert sorted(r["id"] for r in kept.collect()) == ["0", "1", "2"]


def test_posts_that_land_months_late_are_kept_and_counted(spark):
    landing, path, checkpoint, counted, counting = (work_folder(spark, n) for n in ("in", "out", "cp", "counts", "cp2"))
    for ids, epoch in ((["new", "same"], 1706659200), (["old", "same", "", ""], 1700000000)):
        posts = spark.createDataFrame([(i, "s", 1) for i in ids], "id string, subreddit string, score long")
        posts = posts.withColumn("created_datetime", F.timestamp_seconds(F.lit(epoch)))
        posts.write.mode("append").parquet(landing)
        stream = feeds.landed_stream(spark, landing, posts.schema)
        kept = feeds.stream_dedupe(stream, path, checkpoint)
        counts = days.count_days(stream, counted, counting)
    assert sorted(r["id"] for r in kept.collect()) == ["", "", "new", "old", "same"]
    assert sorted((r["posts"], r["late_posts"], r["closed"]) for r in counts.collect()) == [(2, 0, False), (4, 4, True)]


def test_failed_scores_are_asked_again(spark):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))
    posts = spark.range(4).selectExpr("cast(id as string) id", "concat('t', id) title", "'x' selftext")
    posts.write.parquet(landing)

    def fails_once(prompts):
        if any("t2" in p for p in prompts):
            raise RuntimeError("no reply")
        return ["10"] * len(prompts)

    first = feeds.score_stream(feeds.landed_stream(spark, landing, posts.schema), fails_once, path, checkpoint)
    assert [r["id"] for r in first.where("score_status = 'failed'").collect()] == ["2"]
    second = feeds.retry_failed(spark, lambda ps: ["30"] * len(ps), path)
    assert sorted((r["id"], r["llm_relevance_score"]) for r in second.collect()) == [("0", 10.0), ("1", 10.0), ("2", 30.0), ("3", 10.0)]


def test_stream_score_passes_over_scored(spark):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))
    posts = spark.range(4).selectExpr("cast(id as string) id", "'t' title", "'x' selftext")
    for reply in ("10", "20"):
        posts.write.mode("append").parquet(landing)
        stream = feeds.landed_stream(spark, landing, posts.schema)
        scored = feeds.score_stream(stream, lambda ps, reply=reply: [reply] * len(ps), path, checkpoint)
    assert sorted((r["id"], r["llm_relevance_score"]) for r in scored.collect()) == [(str(i), 10.0) for i in range(4)]


def test_batches_read_what_lands_and_not_what_has_landed(spark, monkeypatch):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))
    started, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **b: started.append(start(self, *a, **b)) or started[-1])
    for k in range(20):  # ten new ids, five of the batch before and the very first one again
        ids = spark.range(max(0, 10 * k - 5), 10 * k + 10).union(spark.range(1))
        posts = ids.selectExpr("cast(id as string) id", "timestamp_seconds(1706659200 - id * 86400) created_datetime")
        posts.coalesce(1).write.mode("append").parquet(landing)
        table = feeds.stream_dedupe(feeds.landed_stream(spark, landing, posts.schema), path, checkpoint)
    assert sorted(int(r["id"]) for r in table.collect()) == list(range(200))
    read = [p["numInputRows"] for q in started for p in q.recentProgress]
    assert len([n for n in read if n]) >= 40 and max(read) <= 32  # a batch of 16 rows, by both branches of a union
    assert len([f for f in list_folder(spark, f"{checkpoint}/staging") if not f.endswith("none")]) <= 1


def test_a_staged_batch_is_not_written_again(spark):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))
    posts = spark.range(5).selectExpr("cast(id as string) id", "timestamp_seconds(id) created_datetime")
    posts.write.parquet(f"{checkpoint}/staging/batch-0")  # a run stopped after it staged its first batch
    publish(spark, f"{checkpoint}/staged/0", "")
    posts.write.parquet(landing)
    table = feeds.stream_dedupe(feeds.landed_stream(spark, landing, posts.schema), path, checkpoint)
    assert sorted(r["id"] for r in table.collect()) == ["0", "1", "2", "3", "4"]


def test_folded_days_count_like_the_posts(spark):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))
    every = []
    for k in range(7):
        rows = [(k * 100 + i, f"s{i % 2}", i, 1706659200 + 86400 * (k * 4 - 37 * (i % 5 == 0))) for i in range(20)] + ([(None, None, None, None)] if k == 3 else [])
        every += rows
        posts = spark.createDataFrame(rows, "id long, subreddit string, score long, t long").withColumn("created_datetime", F.timestamp_seconds("t"))
        posts.write.mode("append").parquet(landing)
        counts = days.count_days(feeds.landed_stream(spark, landing, posts.schema), path, checkpoint, fold_every=3)
        if k == 5:
            days.fold_versions(spark, path, 5, 3)  # comes twice after a failure
    day = lambda t: None if t is None else t // 86400 * 86400
    want, newest = {}, None
    for k in range(7):
        batch = every[k * 20 + (k > 3) : (k + 1) * 20 + (k > 3) + (k == 3)]
        for _, s, score, t in batch:
            n, total, late = want.get((day(t), s), (0, 0, 0))
            is_late = t is not None and newest is not None and day(t) + 3 * 86400 <= newest
            want[day(t), s] = n + 1, total + (score or 0), late + is_late
        newest = max([newest or 0, *(t for *_, t in batch if t is not None)])
    got = {(r["t"], r["subreddit"]): (r["posts"], r["total_score"] or 0, r["late_posts"]) for r in counts.select("*", F.unix_seconds("day").alias("t")).collect()}
    assert got == want and any(late for _, _, late in want.values())
    assert len(list_folder(spark, f"{path}/versions")) <= 4


def test_failed_posts_are_asked_again_by_the_next_batch(spark):
    landing, path, checkpoint = (work_folder(spark, n) for n in ("in", "out", "cp"))

    def fails(prompts):
        if any("t2" in p or "t5" in p for p in prompts):
            raise RuntimeError("no reply")
        return ["10"] * len(prompts)

    for k, score in enumerate((fails, fails, lambda ps: ["30"] * len(ps))):
        posts = spark.range(k * 3, k * 3 + 3).selectExpr("cast(id as string) id", "concat('t', id) title", "'x' selftext")
        posts.write.mode("append").parquet(landing)
        table = feeds.score_stream(feeds.landed_stream(spark, landing, posts.schema), score, path, checkpoint)
        if k == 1:
            assert sorted(r["id"] for r in table.where("score_status = 'failed'").collect()) == ["2", "5"]
            again = feeds.retry_failed(spark, lambda ps: ["20" if "t2" in p else "" for p in ps] if len(ps) == 1 else [], path)
            assert {r["id"]: r["llm_relevance_score"] for r in again.collect()}["2"] == 20.0
    got = {r["id"]: (r["llm_relevance_score"], r["score_status"]) for r in table.collect()}
    assert got == {**dict.fromkeys("0134", (10.0, "scored")), "2": (20.0, "scored"), **dict.fromkeys("678", (30.0, "scored")), "5": (50.0, "scored")}


def test_written_json_lines_are_read_back_whole(spark, tmp_path):
    path = f"{tmp_path}/posts.json"
    spark.range(10).selectExpr("cast(id as string) as id", "concat('t', id) as title").write.json(path)
    assert sorted(r["id"] for r in files.load_posts(spark, path).collect()) == [str(i) for i in range(10)]


def test_blank_ids_are_kept_and_counted_alike(spark):
    rows = [("a", 1), ("a", 1), ("", 1), ("", 1), (None, 1)]
    posts = spark.createDataFrame(rows, "id string, created_utc long")
    assert dedupe_posts(posts, ["created_utc"]).count() == 4
    assert duplicate_count(posts).first().asDict() == {"total_rows": 5, "unique_rows": 4, "duplicates": 1}


def test_numbers_too_large_for_a_whole_number_become_zero(spark):
    posts = spark.createDataFrame([("Infinity",), ("1e30",), ("7",)], "score string")
    assert [r[0] for r in posts.select(coerce(posts, "score", "bigint")).collect()] == [0, 0, 7]


def test_array_over_many_lines_is_read_by_many_tasks(spark, tmp_path):
    """Records, also such as lie in several splits, come whole and in order; more than one task reads the file."""
    posts = [{"id": str(i), "title": 'a ] } " [ \\ {' * (i % 5), "selftext": "x\n" * (i % 90), "comments": [comment("b")] * (i % 3)} for i in range(400)]
    forms = {
        "indented": json.dumps(posts, indent=2), "packed": "[" + ",\n".join(json.dumps(p) for p in posts) + "]",
        "mixed": json.dumps(posts, indent=1).replace("},\n {", "}, {"),
    }
    with settings(spark, spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="0"):
        for name, text in forms.items():
            path = tmp_path / f"{name}.json"
            path.write_text(text)
            df = files.read_posts_json(spark, str(path))
            rows = df.orderBy(files.POSITION).collect()
            assert [(r["id"], r["title"], r["selftext"], len(r["comments"])) for r in rows] == [
                (p["id"], p["title"], p["selftext"], len(p["comments"])) for p in posts
            ], name
            assert len({r[files.POSITION]["file_block_start"] for r in rows}) > 20
        for text in ('[\n{"id": "1"},\n oops\n]', '[\n{"id": "1"},\n{"id": \n', '[\n{"id": "1},\n{"id": "2"}\n]', '[\n{"id": 1 2}\n]'):
            path = tmp_path / "broken.json"
            path.write_text(text)
            with pytest.raises(Exception):  # noqa: B017
                files.read_posts_json(spark, str(path)).collect()
    (tmp_path / "one.json").write_text('{\n"id": "7",\n"title": "t"\n}')
    assert [r["id"] for r in files.read_posts_json(spark, str(tmp_path / "one.json")).collect()] == ["7"]
    (tmp_path / "none.json").write_text("[\n]")
    assert files.read_posts_json(spark, str(tmp_path / "none.json")).count() == 0
