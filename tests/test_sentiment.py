"""Sentiment rules one by one, and the joined form against the in-row form."""

import math
import random

import pytest
from pyspark.sql import functions as F

from forumlens.functions.lookup import config_table
from forumlens.functions.text import clean_for_sentiment
from forumlens.operators import sentiment as module
from forumlens.operators.sentiment import FIELDS, STARTER_LEXICON, Lexicon, add_sentiment, emphasis, score_by_join, sentiment, sentiments, token_valences
from forumlens.schema import COMMENT

LEXICON = Lexicon({"good": 2.0, "bad": -2.0, "very": 1.0}, {"very": 0.3, "hardly": -0.3}, ("not",))


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


CASES = [
    ("good day", 2.0),
    ("good BAD thing", 2.0 - 2.0 - 0.733),
    ("GOOD BAD", 0.0),
    ("hardly good", 2.0 - 0.3),
    ("hardly the good", 2.0 - 0.3 * 0.95),
    ("hardly of the good", 2.0 - 0.3 * 0.9),
    ("hardly one of the good", 2.0),
    ("hardly bad", -2.0 + 0.3),
    ("HARDLY good x", 2.0 + (-0.3 + 0.733)),
    ("not good", 2.0 * -0.74),
    ("not hardly good", (2.0 - 0.3) * -0.74),
    ("not so not good", 2.0 * -0.74 * -0.74),
    ("very good", 2.0),
    ("good but bad", 2.0 * 0.5 - 2.0 * 1.5),
    ("good!!", 2.0 + 2 * 0.292),
    ("bad !!!!!!", -2.0 - 4 * 0.292),
    ("good??", 2.0 + 2 * 0.18),
    ("good ????", 2.0 + 0.96),
    ("plain words", 0.0),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(CASES)], "id string, text string")
    rows = df.select("id", sentiment(F.col("text"), LEXICON).alias("s")).select("id", "s.*").collect()
    return {r["id"]: r for r in rows}


@pytest.mark.parametrize("case", range(len(CASES)), ids=[t for t, _ in CASES])
def test_rule(scored, case):
    assert scored[str(case)]["compound"] == pytest.approx(compound(CASES[case][1]), abs=1e-4)


def test_shares(spark):
    row = spark.range(1).select(sentiment(F.lit("good day then bad"), LEXICON).alias("s")).select("s.*").first()
    assert (row["pos"], row["neg"], row["neu"]) == (0.375, 0.375, 0.25)
    assert (row["class"], row["priority"]) == ("neutral", 50.0)


@pytest.mark.parametrize("text", [None, "", "   ", "https://x.y", "@you #tag"])
def test_blank(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(sentiment(F.col("t"), LEXICON).alias("s")).select("s.*").first()
    assert tuple(row[f] for f in FIELDS) == (0.0, 0.0, 1.0, 0.0, "neutral", 50.0)


def test_joined_form_agrees(spark):
    texts = [t for t, _ in CASES] + ["", None, "x"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    table = config_table(spark, [{"token": w, "valence": v} for w, v in LEXICON.valence.items()], "token string, valence double")
    joined = {r["id"]: r for r in score_by_join(df, "text", table, LEXICON).collect()}
    in_row = df.select("id", sentiment(F.col("text"), LEXICON).alias("s")).select("id", "s.*").collect()
    assert {r["id"]: r.asDict() for r in in_row} == {k: r.asDict() for k, r in joined.items()}


def test_table_too_large_is_refused(spark):
    table = spark.range(50_001).select(F.col("id").cast("string").alias("token"), F.lit(1.0).alias("valence"))
    with pytest.raises(ValueError):
        Lexicon.from_table(table, {}, ())


def test_posts(spark):
    comment = {f.name: None for f in COMMENT.fields}
    bodies = ["short", "this is a good one", "this is a bad one", "fine fine fine fine", "x" * 20, "good good good good good"]
    comments = [{**comment, "body": b} for b in bodies]
    schema = "id string, title string, selftext string, comments_collected int"
    df = spark.createDataFrame([("1", "good", "tiny", 6), ("2", "bad", None, 0)], schema)
    nested = F.from_json(F.lit(__import__("json").dumps(comments)), F.schema_of_json(F.lit('[{"body":"x"}]')))
    rows = {r["id"]: r for r in add_sentiment(df.withColumn("comments", nested), LEXICON).collect()}
    good, bad = rows["1"], rows["2"]
    assert good["content_sentiment_priority"] == good["title_sentiment_priority"]
    one = spark.range(1).select(sentiment(F.lit(bodies[1]), LEXICON)["priority"], sentiment(F.lit(bodies[2]), LEXICON)["priority"]).first()
    assert good["comments_sentiment_avg"] == pytest.approx((one[0] + one[1] + 50 + 50) / 4)
    assert bad["comments_sentiment_avg"] == 50.0
    flat = add_sentiment(df.drop("comments_collected"), STARTER_LEXICON).where("id = '1'").first()
    assert flat["overall_sentiment_score"] == pytest.approx(flat["title_sentiment_priority"], abs=0.01)


WORDS = (
    "good GOOD Good. _good_ bad BAD, bad!! very VERY hardly not never no NO nor or so this without doubt least at but But BUT kind of sort "
    "the shit bomb to die for kiss death yeah right bus stop x I é É ÉTÉ été straße STRASSE good—bad “good” naïve 好 ½ ?? a?b ... _ @you #tag "
    "http://a.b/c?d www.x.y I'm don't\u00a0good \u2028 \x85 \t \n good\x00bad ΟΔΟΣ οδος İ ŉ"
).split(" ")
LEXICONS = {
    "plain": LEXICON,
    "phrases": Lexicon(
        {"good": 1.9, "bad": -2.5, "no": -1.2, "kind": 2.4, "die": -2.9, "stop": -1.2, "été": 0.7, "straße": -0.3, "right": 0.1},
        {"very": 0.293, "hardly": -0.293, "so": 0.293, "kind of": -0.293, "sort of": -0.293, "to the very": 0.5},
        ("not", "never", "without", "no", "nor"), {**STARTER_LEXICON.idioms, "good bad": 1.1, "so good this": -0.4, "a b c d": 9.0, "good": 7.0},
    ),
    "least": Lexicon({"least": -0.5, "good": 1.9, "but": 0.4}, {}, ()),
}


@pytest.mark.parametrize("lexicon", LEXICONS.values(), ids=LEXICONS)
def test_batches_follow_the_rules_of_single_rows(spark, monkeypatch, lexicon):
    """Sums of texts worked through by batches are those of valences found token by token, to the last digit."""
    monkeypatch.setattr(module, "TEXTS_AT_ONCE", 7)
    draw = random.Random(4)
    texts = [" ".join(draw.choices(WORDS, k=draw.randrange(25))) for _ in range(400)] + [None, "", " ", "!", "?!", "__", "“", "http://x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    cleaned = df.select("id", "text", clean_for_sentiment(F.col("text")).alias("clean"))
    found = cleaned.select("id", "clean", token_valences(F.col("clean"), lexicon)["valence"].alias("values"), emphasis(F.col("clean")).alias("marks"))
    sums = module.by_slices(module.Rules(lexicon).sums, module.SUMS, module.SUMS_TYPE, 7)
    got = {r["id"]: r["sums"] for r in df.select("id", sums(module._prepared(F.col("text"))).alias("sums")).collect()}
    carried = 0
    for row in found.collect():
        if not row["clean"]:
            assert got[row["id"]] is None
            continue
        total = up = down = 0.0
        for value in row["values"]:
            total, up, down = total + value, up + (value + 1 if value > 0 else 0.0), down + (value - 1 if value < 0 else 0.0)
        neutral = len(row["clean"].split(" ")) - sum(value != 0 for value in row["values"])
        assert tuple(got[row["id"]]) == (total, up, down, neutral, row["marks"]), texts[row["id"]]
        carried += len(row["values"])
    assert carried > 300


def test_lists_of_texts_are_scored_like_single_ones(spark):
    texts = [t for t, _ in CASES] + ["", None, "http://x"]
    df = spark.createDataFrame([(1, texts), (2, []), (3, None)], "id int, texts array<string>")
    got = {r["id"]: r["s"] for r in df.select("id", sentiments(F.col("texts"), LEXICON).alias("s")).collect()}
    single = df.where("id = 1").select(F.posexplode("texts").alias("place", "text")).select("place", sentiment(F.col("text"), LEXICON).alias("s"))
    assert got[1] == [r["s"] for r in single.orderBy("place").collect()] and got[2] == [] and got[3] is None


def test_sentiment_of_posts_runs_no_lambda_over_tokens(spark):
    df = spark.createDataFrame([("1", "good", "this is a good one", 0)], "id string, title string, selftext string, comments_collected int")
    plan = add_sentiment(df, LEXICON)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "split(" not in plan and plan.count("BatchEvalPython") == 0
