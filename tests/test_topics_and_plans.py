"""Factorisation against plain NumPy, and the whole analysis on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.operators import nmf, topics
from forumlens.operators.nmf import fit_nmf, sparse_parts
from forumlens.operators.relevance import RelevanceRules
from forumlens.operators.topics import fit_topics, perform_topic_modeling
from forumlens.operators import collect
from forumlens.plans import jobs
from forumlens.plans.analysis import Settings, analyze, analyze_combined, analyze_folder
from forumlens.plans.collection import SearchSettings, collect_and_analyze, user_collection
from forumlens.session import list_folder, path_exists, work_folder


def dense_nmf(v, k, sweeps):
    """Coordinate descent on whole matrices, from the same kind of start."""
    u, s, vt = np.linalg.svd(v, full_matrices=False)
    w, h = np.zeros((v.shape[0], k)), np.zeros((k, v.shape[1]))
    for j in range(k):
        x, y = u[:, j], vt[j]
        if j == 0:
            a, b, size = np.abs(x), np.abs(y), 1.0
        else:
            options = [(np.maximum(x * d, 0), np.maximum(y * d, 0)) for d in (1, -1)]
            a, b = max(options, key=lambda o: np.linalg.norm(o[0]) * np.linalg.norm(o[1]))
            size = np.linalg.norm(a) * np.linalg.norm(b)
            a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
        w[:, j], h[j] = np.sqrt(s[j] * size) * a, np.sqrt(s[j] * size) * b
    w[w < 1e-6], h[h < 1e-6] = 0, 0
    losses = []
    for _ in range(sweeps):
        for t in range(k):
            w[:, t] = np.maximum(w[:, t] - (w @ (h @ h[t]) - v @ h[t]) / (h[t] @ h[t]), 0)
        used = w.copy()
        for t in range(k):
            h[t] = np.maximum(h[t] - (w[:, t] @ w @ h - w[:, t] @ v) / (w[:, t] @ w[:, t]), 0)
        losses.append(np.linalg.norm(v - w @ h))
    return used, h, losses


def sparse(spark, v):
    rows = [(i, (np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist())) for i, r in enumerate(v)]
    return spark.createDataFrame(rows, "id int, x struct<indices:array<int>,values:array<double>>")


def test_nmf_agrees_with_plain_numpy(spark):
    rng = np.random.default_rng(5)
    v = np.abs(rng.normal(size=(60, 12))) * (rng.random((60, 12)) < 0.6)
    v[7] = 0
    df = sparse(spark, v).repartition(5)
    model = fit_nmf(df, "x", k=3, max_iter=25, tolerance=0.0, n_terms=12)
    w, h, losses = dense_nmf(v, 3, 25)
    assert np.allclose(model.components, h, atol=1e-6) and (model.components >= 0).all()
    got = df.select("id", model.weights(*sparse_parts("x"), df).alias("w")).toPandas().set_index("id")["w"]
    assert np.allclose(np.stack([got[i] for i in range(60)]), w, atol=1e-6)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))


def test_factors_are_the_same_for_any_partitions(spark, monkeypatch):
    rng = np.random.default_rng(8)
    df = sparse(spark, np.abs(rng.normal(size=(700, 20))) * (rng.random((700, 20)) < 0.3))
    fits = []
    for parts, at_once in ((1, 64), (3, 64), (11, 2)):  # the last adds its sums in four rounds
        monkeypatch.setattr(nmf, "SUMS_AT_ONCE", at_once)
        monkeypatch.setattr(nmf, "ROWS_PER_BLOCK", 64 * parts)
        fits.append(fit_nmf(df.repartition(parts, "id"), "x", k=4, max_iter=23, tolerance=0.0, n_terms=20))
    assert all(np.array_equal(fits[0].components, f.components) and fits[0].violations == f.violations for f in fits[1:])


def test_sketched_vocabulary_is_exact_or_counts_all(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = [f"w{int(x)}" for x in np.minimum(rng.zipf(1.4, 30_000), 5_000)]
    rows = [(str(i), "title", " ".join(words[i * 30 : i * 30 + 30])) for i in range(1000)]
    table = topics.term_table(spark.createDataFrame(rows, "id string, title string, selftext string").repartition(7), ["title"])
    want = [tuple(r) for r in topics.vocabulary_table(table, 40).collect()]
    whole = []
    count_all = topics.term_counts
    monkeypatch.setattr(topics, "term_counts", lambda t: whole.append(1) or count_all(t))
    monkeypatch.setattr(topics, "SKETCHES_AT_ONCE", 2)
    for tracked in (16, 6_000, 20_000):
        assert [tuple(r) for r in topics.vocabulary_table(table, 40, tracked=tracked).collect()] == want
    assert len(whole) == 1  # only the smallest sketch proves nothing


@pytest.fixture(scope="module")
def posts(spark):
    themes = {"etl": "etl pipeline extract load warehouse", "cats": "kitten whiskers purring feline", "garden": "tomato soil compost seedling"}
    rows = []
    for i in range(60):
        theme = list(themes)[i % 3]
        words = themes[theme].split()
        text = " ".join(words[(i + j) % len(words)] for j in range(6))
        rows.append((str(i), f"{theme} thread", text, i % 40, 0.9, i % 12, float(i % 100), i % 100 / 24, f"sub{i % 4}", "daily"))
    schema = "id string, title string, selftext string, score bigint, upvote_ratio double, num_comments bigint, hours_ago double, days_ago double, subreddit string, kind string"
    return spark.createDataFrame(rows, schema).withColumn("created_utc", 1706659200 - F.col("hours_ago") * 3600)


def test_topics_separate_themes(posts):
    assigned = perform_topic_modeling(posts, n_topics=3, stop_words=["thread"], max_iter=40)
    by_theme = assigned.groupBy(F.col("id").cast("int") % 3).agg(F.countDistinct("topic_id").alias("n"), F.min("topic_id").alias("t")).collect()
    assert all(r["n"] == 1 for r in by_theme) and len({r["t"] for r in by_theme}) == 3
    assert assigned.where("topic_name like 'etl%'").count() == 20
    assert assigned.columns == [*posts.columns, "topic_id", "topic_probability", "topic_name"]


def test_too_few_posts_pass_through(posts):
    few = posts.limit(3)
    assert fit_topics(few) is None
    assert perform_topic_modeling(few).columns == few.columns


SETTINGS = Settings(fixed.PRESET_WEIGHTS, fixed.PRESET_THRESHOLDS, topics=3, stop_words=["thread"], topic_iterations=15)


def test_combined_analysis_of_files(spark, posts):
    base = work_folder(spark, "landed")
    paths = [f"{base}/daily_a.parquet", f"{base}/search_b.parquet"]
    posts.where("id < 40").write.parquet(paths[0])
    posts.where("id >= 20").write.parquet(paths[1])
    result = analyze_combined(spark, paths, SETTINGS)
    rows = result.posts.collect()
    assert len(rows) == 20 and {r["topic_name"][:3] for r in rows} == {"etl"}
    assert {r["collection_type"] for r in rows} == {"daily_subreddits", "keyword_search"}
    assert [r["relevance_score"] for r in rows] == sorted((r["relevance_score"] for r in rows), reverse=True)
    out = result.save(f"{base}/out", unfiltered=True)
    assert [spark.read.parquet(p).count() for p in out] == [20, 20]
    assert result.report["dataset_overview"].first()["total_posts"] == 20


def test_nothing_relevant_gives_an_empty_frame(posts):
    strict = Settings(rules=RelevanceRules([], [], [], [], []), topics=2, topic_iterations=2, stop_words=["thread"])
    result = analyze(posts, strict).posts
    assert result.count() == 0 and "engagement_score" in result.columns


def test_collect_and_analyze_kinds(spark, posts):
    tiers = {"high": {"subreddits": ["sub0", "sub1"], "posts_per_sub": 9, "time_filter": "week", "description": "x"}}
    plan = SearchSettings(["etl"], ["etl pipeline"], ["sub2"], 10)
    daily = collect_and_analyze(posts, None, 1706659200, "daily", tiers, plan, SETTINGS).scored
    search = collect_and_analyze(posts, None, 1706659200, "search", tiers, plan, SETTINGS).scored
    assert {r["collection_type"] for r in daily.collect()} == {"daily_subreddits"}
    assert {r["collection_type"] for r in search.collect()} == {"keyword_search"}
    with pytest.raises(ValueError):
        collect_and_analyze(posts, None, 0, "hourly")


def test_user_collection(spark):
    rows = [(str(i), "u1" if i % 2 else "u2", "[removed]" if i == 1 else "text", i, i * 100, "s", i) for i in range(10)]
    df = spark.createDataFrame(rows, "comment_id string, author string, body string, score int, created_utc bigint, subreddit string, days_ago int")
    comments, stats = user_collection(df, ["u1", "nobody"], limit=4)
    assert sorted(r["comment_id"] for r in comments.collect()) == ["3", "5", "7", "9"]
    assert {r["target_username"]: r["total_comments"] for r in stats.collect()} == {"u1": 4, "nobody": 0}


def test_fewer_themes_than_topics_give_finite_factors(spark):
    themes = np.kron(np.eye(3), [0.6, 0.5, 0.62])
    components = np.asarray(fit_nmf(sparse(spark, np.repeat(themes, 2, axis=0)), "x", 8, 50).components)
    assert np.isfinite(components).all() and (components >= 0).all() and components.any()


def test_report_tells_the_topics(spark, posts):
    result = analyze(posts, SETTINGS)
    info = {r["topic_id"]: r for r in result.report["topic_info"].collect()}
    assert sorted(info) == [0, 1, 2] and sum(r["posts"] for r in info.values()) == 20
    assert result.report["topic_terms"].where("place = 1").count() == 3
    folder = work_folder(spark, "report")
    assert {p.rsplit("/", 1)[-1] for p in result.save_report(folder)} >= {"topic_info", "top_posts", "dataset_overview"}
    plain = analyze(posts, Settings(fixed.PRESET_WEIGHTS, fixed.PRESET_THRESHOLDS, topics=0, cut=30))
    assert "topic_id" not in plain.posts.columns and "topic_info" not in plain.report and plain.scored.count() == 20


# ---- jobs over landed tables ---------------------------------------------------------------
@pytest.fixture(scope="module")
def landed(spark, posts):
    """Posts and comments as a feed delivers them."""
    feed = posts.selectExpr(
        "id", "title", "nullif(concat('u', cast(id as int) % 5), 'u0') author", "score", "upvote_ratio", "num_comments", "created_utc",
        "concat('http://x/', id) url", "concat('/r/', subreddit, '/', id) permalink", "selftext", "true is_self", "'self' domain", "subreddit",
        "'flair' link_flair_text", "false is_video", "false stickied", "false over_18", "false spoiler", "false locked",
    )
    rows = [(str(p), f"{p}_{c}", f"t3_{p}", "a", f"etl comment {c}" if c else "[deleted]", c, 1706659200.0 - 3600 * c, False, False, 0) for p in range(60) for c in range(4)]
    schema = "post_id string, comment_id string, parent_id string, author string, body string, score bigint, created_utc double, is_submitter boolean, stickied boolean, depth int"
    return feed, spark.createDataFrame(rows, schema)


TIERS = {
    "high": {"subreddits": ["sub0", "sub1"], "posts_per_sub": 5, "time_filter": "week", "description": "x"},
    "low": {"subreddits": ["sub2", "sub0"], "posts_per_sub": 2, "time_filter": "day", "description": "y"},
}


def test_whole_job_writes_everything(spark, landed):
    feed, comments = landed
    folder = work_folder(spark, "job")
    plan = SearchSettings(["etl"], ["etl pipeline"], ["sub2"], 10)
    result = jobs.whole_job(feed, comments, folder, 1706659200, "both", TIERS, plan, SETTINGS, unfiltered=True)
    daily = spark.read.parquet(f"{folder}/daily_collection.parquet")
    assert daily.groupBy("activity_tier").count().orderBy("activity_tier").collect() == [("high", 10), ("low", 4)]
    row = daily.where("author = '[deleted]'").first()
    assert row["permalink"].startswith(fixed.PERMALINK_BASE) and [c["score"] for c in row["comments"]] == [3, 2, 1] and row["target_posts"] in (5, 2)
    assert spark.read.parquet(f"{folder}/hybrid_search.parquet").where("search_location is not null and days_ago >= 0").count() > 0
    assert set(names(spark, f"{folder}/reports")) == {"daily_collection", "hybrid_search", "combined"}
    assert {"tier_stats", "progress", "collection_summary"} <= set(names(spark, f"{folder}/reports/daily_collection"))
    kept, scored = (spark.read.parquet(f"{folder}/combined_analyzed_{x}") for x in ("", "_unfiltered"))
    assert kept.count() == result.posts.count() > 0 and kept.count() <= scored.count() == scored.select("id").distinct().count()
    again = analyze_folder(spark, folder, SETTINGS)  # earlier results in the folder are passed over
    assert again.posts.count() == kept.count()
    assert list(map(tuple, jobs.Run(spark, f"{folder}/runs/daily_collection").progress().collect())) == [("000-00000", ["sub0", "sub1"], 10, 10), ("001-00000", ["sub2", "sub0"], 4, 14)]


def names(spark, folder):
    return [p.rsplit("/", 1)[-1] for p in list_folder(spark, folder)]


def test_a_stopped_collection_goes_on_with_the_next_step(spark, landed, monkeypatch):
    feed, comments = landed
    folder, asked = work_folder(spark, "stopped"), []
    make = jobs._tier_step

    def stops(posts, comments, as_of, tier, setting, max_comments):
        asked.append(setting["subreddits"])
        if len(asked) == 3:
            raise RuntimeError("stopped")
        return make(posts, comments, as_of, tier, setting, max_comments)

    monkeypatch.setattr(jobs, "_tier_step", stops)
    with pytest.raises(RuntimeError):
        jobs.daily_job(feed, comments, folder, 1706659200, TIERS, step_subreddits=1)
    path = jobs.daily_job(feed, comments, folder, 1706659200, TIERS, step_subreddits=1)
    assert asked == [["sub0"], ["sub1"], ["sub2"], ["sub2"], ["sub0"]]
    whole = jobs.daily_job(feed, comments, work_folder(spark, "whole"), 1706659200, TIERS)
    keys = ["id", "activity_tier", "comments_collected"]
    assert sorted(map(tuple, spark.read.parquet(path).select(keys).collect())) == sorted(map(tuple, spark.read.parquet(whole).select(keys).collect()))


def test_user_job(spark):
    rows = [(str(i), "text", f"u{i % 2}", i, 1706659200.0 - i * 3600, "s", "/c", "t", "p", "t3", False, False, 0, 0, None) for i in range(10)]
    schema = (
        "comment_id string, body string, author string, score bigint, created_utc double, subreddit string, permalink string, post_title string, post_id string,"
        " parent_id string, is_submitter boolean, stickied boolean, gilded bigint, controversiality bigint, edited_utc double"
    )
    folder = work_folder(spark, "users")
    path = jobs.user_job(spark.createDataFrame(rows, schema), ["u1", "nobody"], folder, 1706659200)
    assert [n for n in names(spark, path) if "=" in n] == ["target_username=u1"]
    stats = {r["target_username"]: r["total_comments"] for r in spark.read.parquet(f"{folder}/reports/users/user_stats").collect()}
    assert stats == {"u1": 5, "nobody": 0}


def test_listing_opens_the_folders_it_lists(spark):
    folder = work_folder(spark, "feed")
    posts = spark.range(4000).selectExpr("cast(id as string) id", "concat('sub', id % 10) subreddit", "id % 97 as score", "1706659200 - (id % 400) * 3600 * 24 as created_utc")
    collect.write_feed(posts, folder)
    schema = posts.schema
    tiers = {"high": {"subreddits": ["sub1", "sub2"], "posts_per_sub": 3, "time_filter": "week", "description": "x"}}
    got = collect.tiered_listing(spark, folder, schema, 1706659200, tiers)
    want = collect.tiered_collection(posts.selectExpr("*", "(1706659200 - created_utc) / 3600.0 as hours_ago"), tiers)
    key = ["id", "subreddit", "score", "activity_tier"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
    days, subs = 8, 2
    opened = collect.read_feed(spark, folder, schema, 1706659200, ["sub1", "sub2"], "week").select(F.input_file_name()).distinct().count()
    everything = collect.read_feed(spark, folder, schema, 1706659200).select(F.input_file_name()).distinct().count()
    assert opened <= days * subs * collect.FEED_SLICES and opened * 50 < everything


def test_terms_counted_by_batches_are_those_of_sql_functions(spark, monkeypatch):
    monkeypatch.setattr(topics, "TEXTS_AT_ONCE", 7)
    rng = np.random.default_rng(4)
    letters = list("ab9_ Z.\n'") + ["é", "ß", "İ", "K", "二", "²", " ", "\U0001d400"]
    rows = [(str(i), [None, "", "the a title x9"][i % 3], None if i % 7 == 0 else "".join(rng.choice(letters, i % 90))) for i in range(300)]
    df = spark.createDataFrame([*rows, ("n", None, None)], "id string, title string, selftext string").repartition(3)
    text = topics.strip(topics.combined_text())
    none = F.array().cast("array<struct<term:string,n:int>>")
    by_functions = F.when(F.char_length(text) > 20, F.coalesce(topics.counted_terms(topics.terms_of(text, ["the", "ab"])), none))
    got = topics.with_terms(df.withColumn("want", by_functions), ["the", "ab"]).collect()
    assert len(got) == 301 and all(r[topics.TERMS] == r["want"] for r in got)
    assert sum(r["want"] is None for r in got) > 10 and sum(len(r["want"] or []) for r in got) > 500


def test_pairs_of_rare_words_are_not_counted(spark, monkeypatch):
    rng = np.random.default_rng(10)
    words = [f"w{int(x)}" for x in np.minimum(rng.zipf(1.5, 30_000), 5_000)]
    rows = [(str(i), "title", " ".join(words[i * 30 : i * 30 + 30])) for i in range(1000)]
    table = topics.term_table(spark.createDataFrame(rows, "id string, title string, selftext string"), ["title"])
    every = topics.term_counts(table).where("document_frequency between 2 and 800").collect()
    for wanted in (1, 40, 3_000, 100_000):  # the last two are more than there are words in enough documents
        want = sorted(((r["term"], r["corpus_count"], r["document_frequency"]) for r in every), key=lambda r: (-r[1], r[0]))[:wanted]
        assert [tuple(r) for r in topics.vocabulary_table(table, wanted).collect()] == want
    counted = []
    count = topics._counted
    monkeypatch.setattr(topics, "_counted", lambda terms: counted.append(terms) or count(terms))
    topics.vocabulary_table(table, 40)
    assert sum(t.select("term").distinct().count() for t in counted) < topics.term_counts(table).count() / 2


def test_topic_passes_work_on_whole_batches(spark, monkeypatch):
    """Neither terms nor vectors nor weights are worked out element by element, by lambdas of SQL functions."""
    df = spark.createDataFrame([(str(i), "a title of it", f"pipeline extract load warehouse {i % 9}") for i in range(40)], "id string, title string, selftext string")
    table = topics.term_table(df, ["of"])
    vocabulary = topics.fit_vocabulary(table)
    features = topics.tfidf_features(topics.with_terms(df, ["of"]), vocabulary)
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan and "rlike" not in plan.lower()
    idf = dict(zip(vocabulary.terms, vocabulary.idf, strict=True))
    for row in features.collect():
        known = [(t["term"], t["n"] * idf[t["term"]]) for t in row[topics.TERMS] if t["term"] in idf]
        norm = sum(w * w for _, w in known) ** 0.5
        assert [vocabulary.terms[i] for i in row["tfidf"]["indices"]] == [t for t, _ in known]
        assert np.allclose(row["tfidf"]["values"], [w / norm for _, w in known])


def test_gram_is_exact_for_a_column_of_ones():
    rows = nmf.Rows(np.arange(257), np.zeros(256, np.int64), np.ones(256))
    assert rows.gram(2).tolist() == [[256 << 48, 0], [0, 0]]


def test_vocabulary_and_vectors_come_from_words_in_order(spark, monkeypatch):
    """The term table holds no pairs; words and pairs are tallied by batches, however many words are paired."""
    monkeypatch.setattr(topics, "TEXTS_AT_ONCE", 5)
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{int(x)}" for x in np.minimum(rng.zipf(1.6, i % 23), 40)) for i in range(200)]
    rows = [(str(i), "a title of twenty-one letters" if i % 4 else None, t or None) for i, t in enumerate(texts)]
    rows += [("none", None, None), ("stops", "title title title title title", "")]
    df = spark.createDataFrame(rows, "id string, title string, selftext string").repartition(3)
    table = topics.term_table(df, ["title", "of"])
    assert table.columns == ["id", topics.WORDS] and table.where("id = 'stops'").first()[topics.WORDS] == ""
    counted = topics.with_terms(df, ["title", "of"]).where(F.col(topics.TERMS).isNotNull())
    every = counted.select(F.inline(topics.TERMS)).groupBy("term").agg(F.sum("n"), F.count("*")).collect()
    want = sorted((tuple(r) for r in every if 2 <= r[2] <= 0.8 * table.count()), key=lambda r: (-r[1], r[0]))[:60]
    assert sum(" " in r[0] for r in want) > 10
    for most in (200_000, 3):
        monkeypatch.setattr(topics, "MOST_PAIRED", most)
        assert [tuple(r) for r in topics.vocabulary_table(table, 60).collect()] == want
    vocabulary = topics.fit_vocabulary(table, 60)
    vectors = [{r["id"]: r["tfidf"] for r in topics.tfidf_features(d, vocabulary).collect()} for d in (table, counted)]
    assert vectors[0] == vectors[1] and len(vectors[0]) > 150 and vectors[0]["stops"]["indices"] == []


def test_texts_are_worked_through_once_for_fit_and_assignment(spark, posts, monkeypatch):
    made = []
    make = topics.with_words
    monkeypatch.setattr(topics, "with_words", lambda *args: made.append(1) or make(*args))
    words = topics.default_stop_words()
    once = topics.worded(posts, words, "title", "selftext")
    got = fit_topics(once, 3, max_iter=9).assign(once).select("id", "topic_id", "topic_probability", "topic_name")
    rows = sorted(got.collect())
    assert len(made) == 1 and "title" not in once.columns
    assert rows == sorted(fit_topics(posts, 3, max_iter=9).assign(posts).select(got.columns).collect()) and len(made) == 3


def test_factorisation_leaves_no_tables_behind(spark, monkeypatch):
    written = []
    write = nmf.write_and_read
    monkeypatch.setattr(nmf, "write_and_read", lambda df, label: written.append(write(df, label)) or written[-1])
    rng = np.random.default_rng(3)
    v = np.abs(rng.normal(size=(90, 10)))
    fit_nmf(sparse(spark, v), "x", k=3, max_iter=11, tolerance=0.0, n_terms=10)
    assert len(written) > 3
    assert not any(path_exists(spark, file) for table in written for file in table.inputFiles())


def test_sums_held_back_are_exact():
    rng = np.random.default_rng(2)
    blocks = [rng.integers(-(2**60), 2**60, 5) for _ in range(50)] + [np.full(5, 2**61), np.full(5, -(2**61))] * 3
    total, other = nmf.Sum(5), nmf.Sum(5)
    for i, block in enumerate(blocks):
        (total if i % 3 else other).add(block)
    total.merge(other.packed())
    total.add(np.ones(5))
    high, low = np.frombuffer(total.packed(), np.int64).reshape(2, -1)
    want = [1 + sum(int(b[j]) for b in blocks) for j in range(5)]
    assert [(int(h) << 32) + int(x) for h, x in zip(high, low)] == want


def test_passes_of_a_fit_fill_all_cores(spark, monkeypatch):
    dealt = []
    deal = nmf._by_block
    monkeypatch.setattr(nmf, "_by_block", lambda df, tasks: dealt.append(tasks) or deal(df, tasks))
    cores = spark.sparkContext.defaultParallelism
    fit_nmf(sparse(spark, np.abs(np.random.default_rng(1).normal(size=(40, 6)))).repartition(cores + 3), "x", k=2, max_iter=2, n_terms=6)
    assert dealt and all(n % cores == 0 for n in dealt)
    assert [nmf._whole_rounds(n, 8) for n in (0, 1, 8, 9, 17)] == [8, 8, 8, 16, 24]


def test_w_is_written_by_the_pass_that_sums_and_more_often_for_more_blocks(spark, monkeypatch):
    """The factors don't depend on how often W is written; no pass goes through V only to write W."""
    rng = np.random.default_rng(6)
    df = sparse(spark, np.abs(rng.normal(size=(300, 12))) * (rng.random((300, 12)) < 0.5)).repartition(4)
    passes, fits = [], []
    advance = nmf._advance
    monkeypatch.setattr(nmf, "_advance", lambda *args: passes.append(args[-1]) or advance(*args))
    for at_most in (1, 3):
        monkeypatch.setattr(nmf, "STEPS_PER_WRITE", at_most)
        fits.append(fit_nmf(df, "x", k=3, max_iter=7, tolerance=0.0, n_terms=12))
    assert passes == [True] * 7 + [False, False, True] * 2 + [False]
    assert np.array_equal(fits[0].components, fits[1].components) and fits[0].violations == fits[1].violations
    assert [nmf._steps_per_write(n, 8) for n in (0, 40, 1500, 3000, 100_000)] == [3, 3, 2, 1, 1]


def test_gram_takes_fewer_rows_only_where_they_do_not_fit(monkeypatch):
    """Short texts have heavy entries; whole blocks are multiplied as far as a double holds their squares."""
    rng, taken = np.random.default_rng(7), []
    starts = np.arange(0, 513, 2)
    rows = nmf.Rows(starts, np.tile([0, 1], 256), rng.random(512))
    dense = np.zeros((256, 2), object)
    units = [int(round(float(x))) for x in np.rint(rows.weights / nmf.GRAM_UNIT)]
    for i in range(256):
        dense[i] = units[2 * i : 2 * i + 2]
    zeros = np.zeros
    monkeypatch.setattr(nmf.np, "zeros", lambda shape, *kind: taken.append(shape) or zeros(shape, *kind))
    assert rows.gram(2).tolist() == (dense.T @ dense).tolist()
    assert max(shape[0] for shape in taken[1:]) > nmf.GRAM_ROWS


def test_assignment_hands_on_no_vectors(spark, posts):
    words = topics.default_stop_words()
    once = topics.worded(posts, words)
    model = fit_topics(once, 3, max_iter=5)
    assigned = model.assign(once)
    plan = assigned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "indices" not in plan
    weights = {r["id"]: r["_w"] for r in model.weighted(once).collect()}
    for row in assigned.collect():
        best = max(weights[row["id"]])
        assert row["topic_id"] == (weights[row["id"]].index(best) if best > topics.WEIGHT_FLOOR else -1)


ODD_TEXTS = [
    "Plain ASCII With Words And 123 Numbers of it", "\u212aelvin and \u0130stanbul are lowered to letters of ASCII", "ÉTÉ Straße ẞ Ǆ ΟΔΟΣ ⅧX Ⓐb n\u0303o ½x é1",
    "unknown \u0378to \u0378 patterns a\ua7cbb and \U0001f600words\U0001f600apart 好ab ab好", "no-break\u00a0space line\u2028sep next\x85line", "", None,
]


def test_words_of_texts_outside_ascii_are_those_of_sql_functions(spark):
    """Signs whose lower case is a letter of ASCII or two signs, letters and signs outside ASCII, and signs without a meaning."""
    df = spark.createDataFrame([(i, t, "a body that is long enough") for i, t in enumerate(ODD_TEXTS)], "id int, title string, selftext string")
    stops = ["of", "and"]
    kept = F.array_join(F.filter(topics.terms_of(topics.strip(topics.combined_text()), stops), lambda t: ~F.contains(t, F.lit(" "))), " ")
    rows = topics.with_words(df, stops).select("id", topics.WORDS, kept.alias("want")).collect()
    assert [r[topics.WORDS] for r in rows] == [r["want"] for r in rows] and "kelvin i stanbul" not in rows[0]["want"]
    assert {r["id"]: r["want"] for r in rows}[1].startswith("kelvin stanbul")


def test_terms_outside_the_vocabulary_are_refused(spark):
    df = sparse(spark, np.abs(np.random.default_rng(1).normal(size=(40, 6))))
    model = fit_nmf(df, "x", k=2, max_iter=2, n_terms=6)
    wide = sparse(spark, np.ones((2, 9)))
    with pytest.raises(Exception, match="numbered from 0 to 5"):
        wide.select(model.weights(*sparse_parts("x"), wide)).collect()


def test_places_of_terms_take_two_bytes_where_they_fit(spark):
    for places in ([0, 3, 65535], [0, 3, 65536]):
        df = spark.createDataFrame([((places, [0.5, 0.25, 1.0]),)], "x struct<indices:array<int>,values:array<double>>")
        row = nmf._pack(df, "x").toPandas().iloc[0]
        assert len(row["terms"]) == (6 if places[-1] < 65536 else 24)
        assert nmf._rows(row).terms.tolist() == places and nmf._rows(row).terms.dtype == np.int64
