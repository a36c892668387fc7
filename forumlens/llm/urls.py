"""URL filters: rules for hosts and paths, and naive Bayes over segmented names for the rest.

Concatenated host names are split into words by a unigram Viterbi search whose word counts come from the
pages' own text. Pages that a rule decides are the training set of a multinomial naive Bayes model over host
words and path tokens. Scores are worked out once per distinct host and per distinct path form.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import Scratch

#: Longest word that a name is split into.
MAX_WORD = 20


def parse_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (host and path in one string) that fits a host, or a subdomain of it, and a path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def word_counts(texts: DataFrame, html: str = "html") -> DataFrame:
    """``(word, n)``: lower-case a-z words of the visible text of all pages, up to ``MAX_WORD`` letters."""
    plain = F.lower(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), "<[^>]*>", " "))
    words = texts.select(F.explode(F.split(plain, "[^a-z]+")).alias("word"))
    return words.where(f"word <> '' and length(word) <= {MAX_WORD}").groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of a name; ``known`` has the count of the word at a start with a length."""
    best = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        options = []
        for size in range(1, min(end, MAX_WORD) + 1):
            n = known.get((end - size, size))
            cost = math.log(n / total) if n else math.log(10.0 / max(total, 10)) - size * math.log(10.0)
            options.append((best[end - size][0] + cost, size))
        best.append(max(options))
    words, end = [], len(name)
    while end:
        words.append(name[end - best[end][1] : end])
        end -= best[end][1]
    return words[::-1]


def segment_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``(name, words)`` of distinct lower-case names. Only counts of a name's own substrings reach its row."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    sizes = F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("name") - F.col("at")))
    parts = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("at")).select("name", "at", F.explode(sizes).alias("size"))
    parts = parts.withColumn("word", F.substr("name", F.col("at") + 1, F.col("size")))
    known = parts.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("at", "size", "n")).alias("known"))

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, known: pd.Series) -> pd.Series:
        rows = zip(name, known, strict=True)
        return pd.Series([split_name(w, {(k["at"], k["size"]): k["n"] for k in (ks if ks is not None else [])}, total) for w, ks in rows])

    return names.join(known, "name", "left").select("name", split("name", "known").alias("words"))


def judge_urls(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every page.

    The longest rule decides; without one, a positive log-odds ``score`` of blocking does. Without pages that
    rules block and pages that rules allow nothing can be learnt, and pages without a rule are allowed. A null
    URL has an empty host and path and is judged by the class shares alone. Repeated rows come back repeated.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = parse_url(F.col("url"))
    form = F.regexp_replace(F.lower(F.col("path")), "[0-9]+", "0")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.select("*", longest_rule(F.col("host"), F.col("path"), rules).alias("rule"), form.alias("form"))
    table = F.create_map(*(F.lit(x) for pair in rules.items() for x in pair)) if rules else F.lit(None).cast("map<string,string>")
    rows = scratch.save(rows.withColumn("by_rule", F.try_element_at(table, F.col("rule"))), "rows")

    hosts = scratch.save(rows.groupBy("host").agg(F.count_if(F.col("by_rule") == "block").alias("bad"), F.count_if(F.col("by_rule") == "allow").alias("good")), "hosts")
    forms = scratch.save(rows.groupBy("form").agg(F.count_if(F.col("by_rule") == "block").alias("bad"), F.count_if(F.col("by_rule") == "allow").alias("good")), "forms")
    names = hosts.select("host", F.explode(F.split("host", "[^a-z]+")).alias("name")).where("name <> ''")
    names = scratch.save(names, "names")
    counts = scratch.save(word_counts(pages), "counts")
    split = scratch.save(segment_names(names.select("name").distinct(), counts), "split")
    words = scratch.save(names.join(split, "name").select("host", F.explode("words").alias("token")), "words")
    tokens = forms.select("form", "bad", "good", F.explode(F.split("form", "[^a-z0-9]+")).alias("token")).where("token <> ''")
    seen = words.join(hosts, "host").select("token", "bad", "good").unionByName(tokens.select("token", "bad", "good"))
    seen = seen.groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    seen = scratch.save(seen, "tokens")
    sums = seen.agg(F.count("*").alias("v"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    prior = hosts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not prior["bad"] or not prior["good"]:
        score = F.lit(0.0)
        judged = rows.withColumn("score", score)
    else:
        ratio = F.log((F.col("bad") + 1) / (sums["bad"] + sums["v"])) - F.log((F.col("good") + 1) / (sums["good"] + sums["v"]))
        weights = scratch.save(seen.select("token", ratio.alias("w")), "weights")
        by_host = scratch.save(words.join(weights, "token").groupBy("host").agg(F.sum("w").alias("host_score")), "by_host")
        by_form = scratch.save(tokens.select("form", "token").join(weights, "token").groupBy("form").agg(F.sum("w").alias("form_score")), "by_form")
        total = F.lit(math.log(prior["bad"] / prior["good"])) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("form_score", F.lit(0.0))
        judged = rows.join(by_host, "host", "left").join(by_form, "form", "left").withColumn("score", F.round(total, 9))
    verdict = F.coalesce("by_rule", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
