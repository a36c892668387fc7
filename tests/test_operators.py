"""Ranking, filters, relevance, engagement and scoring on small frames."""

import random
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions import text
from forumlens.operators import scoring, search
from forumlens.operators.collect import collect_user_comments, user_stats
from forumlens.operators.engagement import calculate_engagement
from forumlens.operators.filters import filter_by_thresholds, two_tier_filter
from forumlens.operators.ranking import dedupe_posts, final_sort, top_n_per_group
from forumlens.operators.relevance import score_relevance
from forumlens.operators.search import BRANCH_TERMS, hybrid_match, keyword_search, multi_keyword_search
from forumlens.operators.topics import counted_terms, terms_of, topic_name
from forumlens.schema import CORE_COLUMNS, harmonize_schema
from forumlens.session import work_folder


def test_top_n_with_a_hot_group(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randint(0, 5)}", rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, score int, id int").repartition(16)
    got = top_n_per_group(df, ["g"], [F.desc("score"), F.asc("id")], 7, rank_name="place", slices=4)
    expected = set()
    for g in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:7]
        expected |= {(g, r[2], place) for place, r in enumerate(best, 1)}
    assert {(r["g"], r["id"], r["place"]) for r in got.collect()} == expected


def test_dedupe(spark):
    rows = [("a", 1, 1), ("a", 1, 2), ("a", 2, 0), ("b", 2, 1), ("", 1, 3), ("", 1, 4), (None, 2, 5), (" ", 2, 6)]
    df = spark.createDataFrame(rows, "id string, f int, r int")
    once = dedupe_posts(df, ["f", "r"])
    key = lambda rs: sorted(map(repr, map(tuple, rs)))
    assert key(once.collect()) == key([("a", 1, 1), ("b", 2, 1), ("", 1, 3), ("", 1, 4), (None, 2, 5), (" ", 2, 6)])
    assert key(dedupe_posts(once, ["f", "r"]).collect()) == key(once.collect())


def test_default_relevance(spark):
    posts = [
        ("1", "Sync Salesforce data", "to BigQuery with an ETL pipeline"), ("2", "google sheets", None),
        ("3", "melted", "nothing"), ("4", "api integration", ""), ("5", None, None),
    ]
    df = spark.createDataFrame(posts, "id string, title string, selftext string")
    scores = {r["id"]: r["relevance_score"] for r in score_relevance(df).collect()}
    # salesforce, bigquery, etl, pipeline, sync; both bonuses; sync.*data, etl.*pipeline
    assert scores["1"] == 50 + 25 + 20 + 30
    assert scores["2"] == 20 + 25
    assert scores["3"] == 10
    assert scores["4"] == 20
    assert scores["5"] == 0
    named = score_relevance(df.withColumn("topic_name", F.lit("etl_3")))
    assert {r["relevance_score"] for r in named.where("id = '5'").collect()} == {30}


def test_comment_match_may_span_two(spark):
    df = spark.createDataFrame([("1", "x", "y")], "id string, title string, selftext string")
    df = df.withColumn("comments", F.array(*[F.struct(F.lit(b).alias("body")) for b in ("about data", None, "LAKE view", "", "d", "etl")]))
    assert score_relevance(df).first()["relevance_score"] == 5


def test_engagement_without_positive_scores(spark):
    df = spark.createDataFrame([("1", -5, 0.9, 0, 0.0), ("2", 0, 0.5, 0, 96.0)], "id string, score bigint, upvote_ratio double, num_comments bigint, hours_ago double")
    rows = {r["id"]: r for r in calculate_engagement(df).collect()}
    assert rows["1"]["engagement_score"] == 28.0 and rows["2"]["engagement_score"] == 10.0
    bare = calculate_engagement(df.select("id")).first()
    assert bare["engagement_score"] == 50 * 0.2 + 50 * 0.1


def test_nan_and_null_fail_thresholds(spark):
    df = spark.createDataFrame([(1, float("nan"), 5), (2, None, 5), (3, 0.9, None), (4, 0.9, 5)], "id int, upvote_ratio double, score int")
    kept = filter_by_thresholds(df, {"min_upvote_ratio": 0.5, "min_score": 1, "max_days_ago": 3})
    assert [r["id"] for r in kept.collect()] == [4]


def test_two_tiers_equal_split_and_union(spark):
    df = spark.range(200).selectExpr("cast(id as string) id", "id % 90 as relevance_score", "id % 70 as engagement_score", "id % 9 as score", "id % 4 as num_comments", "0.6 as upvote_ratio", "cast(id % 20 as double) as days_ago")
    low = filter_by_thresholds(df.where("relevance_score < 50"), fixed.PRESET_THRESHOLDS)
    split = df.where("relevance_score >= 50").unionByName(low)
    kept = two_tier_filter(df, fixed.PRESET_THRESHOLDS)
    assert sorted(r["id"] for r in kept.collect()) == sorted(r["id"] for r in split.collect())


def test_final_sort_puts_nulls_last(spark):
    rows = [("a", 60, "neutral", 1.0), ("b", 60, "positive", None), ("c", 60, "positive", 2.0), ("d", None, "positive", 9.0), ("e", 60, None, 3.0)]
    df = spark.createDataFrame(rows, "id string, relevance_score int, overall_sentiment_class string, engagement_score double")
    assert [r["id"] for r in final_sort(df).collect()] == ["c", "b", "e", "a", "d"]


def test_harmonize_is_complete_and_typed(spark):
    df = spark.createDataFrame([("1", "12.7", "False", "bad", "high")], "id string, score string, is_self string, hours_ago string, activity_tier string")
    row = harmonize_schema(df)
    assert set(CORE_COLUMNS) <= set(row.columns)
    first = row.first()
    assert (first["score"], first["is_self"], first["hours_ago"], first["tier"], first["comments"], first["days_ago"]) == (12, False, 0.0, "high", [], 0.0)


def test_search_needs_whole_words(spark):
    rows = [("1", "data tools", "", 10, 1.0), ("2", "database tools", "", 99, 1.0), ("3", "tools", "Data, data!", 5, 1.0), ("4", "data tools", "", 7, 400.0)]
    df = spark.createDataFrame(rows, "id string, title string, selftext string, score int, hours_ago double").withColumn("subreddit", F.lit("s"))
    found = {r["id"]: r["occurrences"] for r in keyword_search(df, "data tools").collect()}
    assert found == {"1": 2, "3": 3}
    assert [r["id"] for r in keyword_search(df, "data tools", limit=1).collect()] == ["3"]


def test_hybrid_match_labels(spark):
    df = spark.createDataFrame([("1", "About ETL", None, ["plain", None]), ("2", "x", "y", ["An ELT tool"]), ("3", "x", "y", [])], "id string, title string, selftext string, b array<string>")
    df = df.withColumn("comments", F.transform("b", lambda b: F.struct(b.alias("body")))).drop("b")
    rows = {r["id"]: (r["found_in_post"], r["found_in_comments"], r["matched_keywords"]) for r in hybrid_match(df, ["ETL", "elt"]).collect()}
    assert rows == {"1": (True, False, ["etl"]), "2": (False, True, ["elt"])}


def test_terms(spark):
    text = F.lit("The café foo_bar X1 a1 42nd the data lake, big lake")
    row = spark.range(1).select(terms_of(text, ["the", "data"]).alias("t"), counted_terms(terms_of(text, ["the", "data"])).alias("c")).first()
    assert row["t"] == ["x1", "a1", "lake", "big", "lake", "x1 a1", "a1 lake", "lake big", "big lake"]
    assert {(r["term"], r["n"]) for r in row["c"]} == {(t, row["t"].count(t)) for t in row["t"]}


@pytest.mark.parametrize(
    "words, name",
    [(["sql", "cloud", "x", "y", "z"], "bigquery_2"), (["pipeline", "dbt"], "etl_2"), (["foo", "bar", "baz"], "foo_bar"), (["foo"], "foo"), (["bid", "zz"], "analytics_1")],
)
def test_topic_name(spark, words, name):
    assert spark.range(1).select(topic_name(F.array(*[F.lit(w) for w in words]))).first()[0] == name


def test_rollup_of_a_long_thread(spark):
    rows = [("p", i, "abcdef" if i % 3 else "\\n\\n\\n\\n") for i in range(1500)] + [("q", 0, " ok "), ("q", 1, "line\\none\ntwo  three")]
    flat = spark.createDataFrame(rows, "post_id string, comment_rank int, body string")
    got = {r["post_id"]: r["comment_text"] for r in scoring.comment_rollup_flat(flat, ["comment_rank"]).collect()}
    parts = ["abcdef" if i % 3 else "" for i in range(1500)]
    assert got == {"p": " | ".join(parts)[:2000] + "... [truncated]", "q": "line one two three"}


def test_failing_model_is_retried_and_marked(spark):
    def score(prompts):
        if any("boom" in p for p in prompts):
            raise RuntimeError("no answer")
        return ["77"] * len(prompts)

    posts = spark.createDataFrame([("1", "fine", None), ("2", "boom", "x"), ("3", "fine too", "")], "id string, title string, selftext string").coalesce(1)
    path = work_folder(spark, "scores")
    first = {r["id"]: (r["llm_relevance_score"], r["score_status"]) for r in scoring.score_table(posts, score, path).collect()}
    assert first == {"1": (77.0, "scored"), "2": (50.0, "failed"), "3": (77.0, "scored")}
    second = {r["id"]: r["llm_relevance_score"] for r in scoring.score_table(posts, lambda ps: ["12"] * len(ps), path).collect()}
    assert second == {"1": 77.0, "2": 12.0, "3": 77.0}


def test_a_long_search_plan_finds_what_a_short_one_does(spark):
    texts = ["red fox", "Red red, FOX fox fox", "fox", "", None, "blue sky and red fox", "skyblue"]
    posts = spark.createDataFrame(
        [(str(i), "s", t, "sky", i, float(i)) for i, t in enumerate(texts)],
        "id string, subreddit string, title string, selftext string, score int, hours_ago double",
    )
    terms = ["fox red", "sky", "blue sky", "fox"]
    rows = lambda df: sorted(map(tuple, df.select("id", "search_query", "occurrences", "search_rank").collect()))
    short = rows(multi_keyword_search(posts, terms, limit=10))
    assert short and len(terms) <= BRANCH_TERMS
    padding = [f"nothing{i} here" for i in range(3_000)]
    assert rows(multi_keyword_search(posts, terms + padding, limit=10)) == short


def test_many_users(spark):
    rows = [(str(i), f"u{i % 15_000}", "text", i, i, "s", 1) for i in range(30_000)]
    comments = spark.createDataFrame(
        pd.DataFrame(rows, columns=["comment_id", "author", "body", "score", "created_utc", "subreddit", "days_ago"])
    )
    users = [f"u{i}" for i in range(5_000, 25_000)]
    stats = user_stats(collect_user_comments(comments, users), users)
    counts = dict(map(tuple, stats.groupBy("total_comments").count().collect()))
    assert counts == {2: 10_000, 0: 10_000}


def test_a_stopped_scoring_run_keeps_its_earlier_buckets(spark, monkeypatch):
    posts = spark.createDataFrame([(str(i), f"title {i}", "body") for i in range(40)], "id string, title string, selftext string")
    path = work_folder(spark, "stopped")
    whole, calls = scoring.score_posts, []

    def breaks(df, *args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        return whole(df, *args)

    monkeypatch.setattr(scoring, "score_posts", breaks)
    with pytest.raises(RuntimeError):
        scoring.score_table(posts, lambda ps: ["80"] * len(ps), path, buckets=4)
    saved = spark.read.parquet(path).count()
    assert 0 < saved < 40
    monkeypatch.setattr(scoring, "score_posts", whole)
    scores = [r["llm_relevance_score"] for r in scoring.score_table(posts, lambda ps: ["12"] * len(ps), path, buckets=4).collect()]
    assert scores.count(80.0) == saved and scores.count(12.0) == 40 - saved


def test_many_keywords_are_found_like_few(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 4))) for _ in range(text.TESTED_ONE_BY_ONE + 100)] + ["", "abc", "abc"]
    texts = ["", None, "abc", "cab bac", *("".join(rng.choice("abcd ") for _ in range(60)) for _ in range(50))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = df.select("t", text.matching(F.col("t"), words).alias("m"), text.contains_any(F.col("t"), words[:-3]).alias("any"), text.count_matching(F.col("t"), words).alias("n"))
    for r in got.collect():
        want = [w for w in words if r["t"] is not None and w in r["t"]]
        assert r["m"] == want and r["n"] == len(want) and bool(r["any"]) == any(w in (r["t"] or "") for w in words[:-3] if r["t"] is not None)


def test_many_keywords_cost_little_more_than_few(spark):
    rng = random.Random(5)
    rows = [(str(i), " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400))) for i in range(4000)]
    posts = spark.createDataFrame(rows, "id string, selftext string").withColumn("title", F.lit("t")).repartition(8).persist()
    posts.count()
    many = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(5000)]

    def seconds(keywords):
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            search.matched_keywords(posts, keywords).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        return min(runs)

    assert seconds(many) < 3 * seconds(many[:5]) + 1
    posts.unpersist()


def test_a_plan_of_thousands_of_searches(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = [(str(i), f"s{rng.randrange(12)}", " ".join(rng.sample(words, 5))) for i in range(400)]
    posts = spark.createDataFrame(rows, "id string, subreddit string, selftext string").withColumn("title", F.lit(None).cast("string"))
    terms = [f"w{i}" for i in range(200)] + [f"w{i} w{i + 1}" for i in range(75)]
    subs = [f"s{i}" for i in range(10)]
    got = {(r["subreddit"], r["term"]): r["candidates"] for r in search.search_plan(posts, terms, subs).collect()}
    assert len(got) == 275 * 11
    for sub in [*subs, None]:
        for term in terms:
            assert got[sub, term] == sum((sub is None or s == sub) and set(term.split()) <= set(t.split()) for _, s, t in rows)


def test_identical_posts_stay_apart_in_searches(spark):
    rows = [("1", "s", "etl tools", 5, 1.0, 3.0, 1), ("1", "s", "etl tools", 5, 1.0, 3.0, 1), (None, "s", "etl again", 4, 1.0, 3.0, 1)]
    posts = spark.createDataFrame(rows, "id string, subreddit string, title string, score int, created_utc double, hours_ago double, num_comments int").withColumn("selftext", F.lit(""))
    found = search.search_candidates(posts, ["etl"], ["s"], 10)
    assert sorted((r["id"] or "", r["search_rank"], r["location_ord"]) for r in found.collect()) == [("", 3, 0), ("", 3, 1), ("1", 1, 0), ("1", 1, 1), ("1", 2, 0), ("1", 2, 1)]


def test_a_model_that_hangs_costs_its_timeout(spark):
    posts = spark.range(12).selectExpr("cast(id as string) id", "concat('post', id) title", "'x' selftext").coalesce(1)

    def hangs(prompts):
        if any("post3" in p for p in prompts):
            time.sleep(60)
        return ["70"] * len(prompts)

    start = time.perf_counter()
    got = scoring.score_posts(posts, hangs, calls=scoring.Calls(prompts=2, in_flight=2, timeout=3.0)).select("id", "score_status", "llm_relevance_score").collect()
    assert time.perf_counter() - start < 30
    assert {r["id"] for r in got if r["score_status"] == "failed"} == {"2", "3"} and all(r["llm_relevance_score"] == 70 for r in got if r["score_status"] == "scored")
    dead = scoring.score_posts(posts, lambda ps: time.sleep(60), calls=scoring.Calls(prompts=1, in_flight=2, timeout=1.0))
    start = time.perf_counter()
    assert dead.where("score_status = 'failed'").count() == 12 and time.perf_counter() - start < 20


def test_progress_ends_at_the_final_averages(spark):
    posts = spark.range(40).selectExpr("cast(id as string) id", "concat('t', id) title", "'x' selftext")
    path = work_folder(spark, "progress")
    spark.range(5).selectExpr("cast(id as string) id", "cast(id as double) llm_relevance_score", "'scored' score_status").write.parquet(path)
    seen = []

    def score(prompts):
        numbers = [int(re.search(r"Title: t([0-9]+)", p)[1]) for p in prompts]
        if any(n % 10 == 9 for n in numbers):
            raise RuntimeError("no reply")
        return [str(n) for n in numbers]

    ranked = scoring.score_table(posts, score, path, buckets=4, report=seen.append).collect()
    good = [r["llm_relevance_score"] for r in ranked if r["score_status"] == "scored"]
    assert len(seen) == 4 and [p.scored for p in seen] == sorted(p.scored for p in seen)
    assert (seen[-1].scored, seen[-1].new, seen[-1].cached, seen[-1].failed) == (36, 31, 5, 4)
    assert abs(seen[-1].average - sum(good) / len(good)) < 1e-9
