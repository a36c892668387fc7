"""Numbers and text against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.lookup import config_table, word_lookup
from forumlens.functions.numeric import clamp, half_even, no_nan, number_or_zero
from forumlens.functions.text import clean_for_sentiment, count_matching, strip
from forumlens.operators.relevance import linear_pattern
from forumlens.operators.scoring import parse_score


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value, expected", [(1.005, 1.0), (1.015, 1.01), (2.5, 2.5), (0.125, 0.12), (0.375, 0.38), (-1.125, -1.12)])
def test_half_even(spark, value, expected):
    assert one(spark, half_even(F.lit(value), 2)) == pytest.approx(expected, abs=1e-12)


def test_clamp_keeps_null(spark):
    assert one(spark, clamp(F.lit(None).cast("double"), 0, 100)) is None
    assert one(spark, clamp(F.lit(120.0), 0, 100)) == 100 and one(spark, clamp(F.lit(-3.0), 0, 100)) == 0


def test_nan_and_bad_numbers(spark):
    assert one(spark, no_nan(F.lit(float("nan")))) is None
    assert [one(spark, number_or_zero(F.lit(v))) for v in ("7.9", "x", "", "NaN")] == [7.9, 0.0, 0.0, 0.0]


def python_clean(text):
    text = re.sub(r"http\S+|www.\S+", "", text)
    text = re.sub(r"@\w+|#\w+", "", text)
    text = re.sub(r"[^\w\s.,!?]", " ", text)
    return re.sub(r"\s+", " ", text).strip()


TEXTS = [
    "See https://a.b/c?d=1 and www.x.y!", "don't @me #now — café über naïve", " a b c\n\nd\te ", "wwww www\n.x", "", "!!??",
    "x_y.z, (1) [2] {3}", "emoji 😀 end", "a\x85b\x1cc",
]


@pytest.mark.parametrize("text", TEXTS)
def test_clean_like_python(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean_for_sentiment(F.col("t"))).first()[0] == python_clean(text)


@pytest.mark.parametrize("text", TEXTS)
def test_strip_like_python(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == text.strip()


def test_word_lookup(spark):
    words = {f"w{i}": float(i) for i in range(500)} | {"é": -1.0}
    df = spark.createDataFrame([(w,) for w in [*words, "other", ""]], "w string")
    found = {r["w"]: r["v"] for r in df.select("w", word_lookup(words)(F.col("w")).alias("v")).collect()}
    assert found == {**words, "other": None, "": None}


def test_config_table_of_any_size(spark):
    assert config_table(spark, [{"a": 1}, {"a": None}], "a int").count() == 2
    rows = [{"b": str(i), "a": i} for i in range(20_000)]
    many = config_table(spark, rows, "a int, b string")
    assert many.columns == ["a", "b"] and many.where("b = cast(a as string)").count() == 20_000


def test_patterns_like_python(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["sync", "data", "etl", "pipeline", "real", "time", "\n", "\r", "x", " "]) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    patterns = [*fixed.BUSINESS_PATTERNS, "a|b.*c", "x.y"]
    rows = df.select("i", *[F.rlike("t", F.lit(linear_pattern(p))).alias(f"p{k}") for k, p in enumerate(patterns)]).collect()
    for r in rows:
        for k, p in enumerate(patterns):
            assert r[f"p{k}"] == bool(re.search(p, texts[r["i"]], re.IGNORECASE)), (p, texts[r["i"]])


def test_duplicate_keywords_count_twice(spark):
    assert one(spark, count_matching(F.lit("google sheets"), ["google sheets", "google sheets", "x"])) == 2


@pytest.mark.parametrize(
    "reply, expected",
    [("85", 85), ("Score: 7/100", 7), ("999", 100), ("1234 then 60", 60), ("none", 50), ("", 50), ("x85 _9", 50), ("ä12 40", 40)],
)
def test_parse_score(spark, reply, expected):
    assert one(spark, parse_score(F.lit(reply))) == expected


def test_fixed_value_counts():
    assert (len(fixed.SOURCE_KEYWORDS), len(fixed.DESTINATION_KEYWORDS), len(fixed.IMPLEMENTATION_KEYWORDS)) == (61, 19, 27)
    assert [len(t["subreddits"]) for t in fixed.TIERS.values()] == [4, 13, 20, 7]
    assert (len(fixed.BUSINESS_PATTERNS), len(fixed.RELEVANT_TOPICS), len(fixed.EXTRA_STOP_WORDS)) == (12, 10, 37)
