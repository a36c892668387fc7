"""Secrets in texts, with DataFrame functions only.

Base patterns find assigned values, access keys and hex strings. Beyond them, every long token is scored by two
first-order character models, one of random strings and one of ordinary identifiers; a token whose mean
log-likelihood ratio is high enough is a secret of kind ``markov``. The models are small tables of character
pairs, counted from labelled samples and kept as a literal array that expressions index.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns in order of kind.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGNED, MIN_ACCESS = 12, 18
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
STATES = len(ALPHABET) + 1
#: Mean log-likelihood ratio of a character from which a token counts as random.
MIN_RATIO = 0.5
SAMPLE_TEXTS, SAMPLE_STRINGS = 2_000, 6_000


def _state(letter: Column) -> Column:
    return F.instr(F.lit(ALPHABET), letter)


def labelled_samples(docs: DataFrame, texts: int = SAMPLE_TEXTS, strings: int = SAMPLE_STRINGS) -> DataFrame:
    """``(token, secret)``: random hex, base64 and alphanumeric strings, and identifiers of sampled texts.

    The identifiers are the words and word pairs of the ``texts`` documents with the smallest hash of their id;
    of rows that share an id the smallest text counts.
    """
    spark = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 256)
    coded = F.base64(F.unhex(digest))
    random = spark.range(strings).select(
        F.when(F.col("id") % 3 == 0, F.substr(digest, F.lit(1), F.lit(40))).when(F.col("id") % 3 == 1, coded)
        .otherwise(F.regexp_replace(coded, "[+/=]", "")).alias("token"), F.lit(True).alias("secret"))
    # ids are ranked without their texts, so the one task that ends a ranking reads numbers only
    ids = docs.select(F.col("doc_id").alias("_id")).orderBy(F.xxhash64("_id"), "_id").limit(texts).distinct()
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    chosen = own.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    words = F.expr(r"regexp_extract_all(text, '[A-Za-z]{3,}', 0)")
    ordinary = chosen.select(F.explode(words).alias("word")).select(F.explode(F.array("word", F.concat(F.lower("word"), F.lit("_"), F.lower("word")))).alias("token"))
    return random.unionByName(ordinary.withColumn("secret", F.lit(False)))


def train_markov(labelled: DataFrame) -> list[float]:
    """Log ratio of every transition, at ``previous * STATES + next``; state 0 is the start or a foreign character.

    ``labelled`` has ``token`` and ``secret``; null tokens are left out. What is collected is at most two counts
    for each pair of states. Without samples all ratios are zero.
    """
    letters = F.transform(F.split("token", ""), _state)
    pairs = F.transform(letters, lambda s, i: F.when(i == 0, 0).otherwise(F.get(letters, i - 1)) * STATES + s)
    counts = labelled.where("token <> ''").select("secret", F.explode(pairs).alias("pair")).groupBy("secret", "pair").count().collect()
    seen = {True: [1.0] * STATES**2, False: [1.0] * STATES**2}
    for row in counts:
        seen[row["secret"]][row["pair"]] += row["count"]
    rows = {k: [sum(v[i * STATES : (i + 1) * STATES]) for i in range(STATES)] for k, v in seen.items()}
    return [math.log(seen[True][i] / rows[True][i // STATES]) - math.log(seen[False][i] / rows[False][i // STATES]) for i in range(STATES**2)]


def _located(pieces: Column, matches: Column, groups: Column) -> Column:
    """Start, end (code points, exclusive) and group of each match, from the pieces between the matches."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)").alias("spans"))

    def step(acc: Column, i: Column) -> Column:
        begin = acc["at"] + F.length(F.get(pieces, i))
        end = begin + F.length(F.get(matches, i))
        span = F.struct(begin.alias("start"), end.alias("end"), F.get(groups, i).alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    indexes = F.when(F.size(matches) > 0, F.sequence(F.lit(0), F.size(matches) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.aggregate(indexes, start, step, lambda acc: acc["spans"])


def mean_ratio(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the characters of a token."""
    table = F.lit(ratios)

    def step(acc: Column, letter: Column) -> Column:
        state = _state(letter)
        return F.struct(state.alias("state"), (acc["total"] + F.get(table, acc["state"] * STATES + state)).alias("total"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0.0).alias("total"))
    return F.aggregate(F.split(token, ""), start, step, lambda acc: acc["total"] / F.length(token))


def find_secrets(docs: DataFrame, ratios: list[float], min_ratio: float = MIN_RATIO) -> DataFrame:
    """``doc_id`` and ``found``: spans (start, kind, end) of a whole text by start, then kind; one row per row.

    ``kind`` is an index of ``KINDS``. A null text is empty. A ``markov`` span never overlaps a base span.
    Other columns are not read, repeated rows come back repeated, an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select("doc_id", text.alias("_text"))
    for k, pattern in enumerate((ASSIGN, ACCESS, HEX, TOKEN)):
        found = found.withColumn(f"_pieces{k}", F.split("_text", pattern, -1))
    none = F.expr("cast(array() as array<string>)")
    for k, pattern in enumerate((ASSIGN, ACCESS, HEX, TOKEN)):
        every = lambda group, p=pattern: F.regexp_extract_all("_text", F.lit(p), F.lit(group))
        any_match = F.size(f"_pieces{k}") > 1
        found = found.withColumns({f"_all{k}": F.when(any_match, every(0)).otherwise(none), f"_group{k}": F.when(any_match, every(2 if k == 0 else 0)).otherwise(none)})
    spans = [_located(F.col(f"_pieces{k}"), F.col(f"_all{k}"), F.col(f"_group{k}")).alias(f"_spans{k}") for k in range(4)]
    found = found.select("doc_id", *spans)
    keep = [
        F.filter("_spans0", lambda s: F.length(s["value"]) >= MIN_ASSIGNED), F.filter("_spans1", lambda s: F.length(s["value"]) >= MIN_ACCESS),
        F.col("_spans2"),
    ]
    tag = lambda spans, kind: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    found = found.select("doc_id", "_spans3", F.concat(*(tag(s, k) for k, s in enumerate(keep))).alias("_base"))
    free = lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    added = F.filter("_spans3", lambda s: free(s) & (mean_ratio(s["value"], ratios) >= min_ratio))
    return found.select("doc_id", F.array_sort(F.concat("_base", tag(added, 3))).alias("found"))


def shown(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
