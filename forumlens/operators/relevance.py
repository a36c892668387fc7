"""Relevance of a post from keywords, patterns, its topic and its first comments."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.text import combined_text, computed_once, contains_any, count_matching


@dataclass(frozen=True)
class RelevanceRules:
    """Word lists and patterns; keywords are lower-case substrings, patterns ignore case."""

    source: list[str] = field(default_factory=lambda: list(fixed.SOURCE_KEYWORDS))
    destination: list[str] = field(default_factory=lambda: list(fixed.DESTINATION_KEYWORDS))
    implementation: list[str] = field(default_factory=lambda: list(fixed.IMPLEMENTATION_KEYWORDS))
    patterns: list[str] = field(default_factory=lambda: list(fixed.BUSINESS_PATTERNS))
    topics: list[str] = field(default_factory=lambda: list(fixed.RELEVANT_TOPICS))

    @property
    def keywords(self) -> list[str]:
        return self.source + self.destination + self.implementation


def linear_pattern(pattern: str) -> str:
    """The same search without backtracking over long lines.

    Words joined by ``.*`` are found in some line in this order if and only if they are when each is
    taken at its first place after the one before; so each step is atomic, once per line. Patterns
    of another form stay as they are. A dot stops at a line feed only.
    """
    words = [w for w in pattern.split(".*") if w]
    if not words or any(re.search(r"[\\^$.|?*+()\[\]{}]", w) for w in words):
        return f"(?di){pattern}"
    if len(words) == 1:
        return f"(?di){words[0]}"
    return "(?dim)^" + "".join(f"(?>.*?{w})" for w in words)


def pattern_hits(text: Column, patterns: list[str]) -> Column:
    """How many of the patterns are found."""
    hits = F.lit(0)
    for pattern in patterns:
        hits = hits + F.rlike(text, F.lit(linear_pattern(pattern))).cast("int")
    return hits.cast("bigint")


def first_comments_text(limit: int = 5) -> Column:
    """Lowercased bodies of the first comments, joined by blanks; a match may span two of them."""
    bodies = F.transform(F.slice("comments", 1, limit), lambda c: F.lower(c["body"]))
    return F.array_join(F.filter(bodies, lambda b: F.coalesce(b, F.lit("")) != ""), " ")


def score_relevance(df: DataFrame, rules: RelevanceRules | None = None) -> DataFrame:
    """Adds ``relevance_score``. Topic and comment terms apply where those columns exist."""
    rules = rules or RelevanceRules()
    texts = {"_text": F.lower(combined_text())}
    if "comments" in df.columns:
        texts["_comments"] = F.coalesce(first_comments_text(), F.lit(""))
    counts = {
        "_source": count_matching(F.col("_text"), rules.source),
        "_destination": count_matching(F.col("_text"), rules.destination),
        "_implementation": count_matching(F.col("_text"), rules.implementation),
        "_patterns": pattern_hits(F.col("_text"), rules.patterns),
    }
    if "comments" in df.columns:
        counts["_in_comments"] = count_matching(F.col("_comments"), rules.keywords)
    scored = computed_once(computed_once(df, texts), counts)
    source, destination, implementation = F.col("_source"), F.col("_destination"), F.col("_implementation")
    points = (source + destination + implementation) * 10 + F.col("_patterns") * 15
    points = points + F.when((source > 0) & (destination > 0), 25).otherwise(0)
    points = points + F.when((implementation > 0) & ((source > 0) | (destination > 0)), 20).otherwise(0)
    if "topic_name" in df.columns:
        points = points + F.when(contains_any(F.lower("topic_name"), rules.topics), 30).otherwise(0)
    if "comments" in df.columns:
        points = points + F.col("_in_comments") * 5
    return scored.withColumn("relevance_score", points.cast("bigint")).drop(*texts, *counts)


def filter_by_relevance(df: DataFrame, rules: RelevanceRules | None = None, cut: int = fixed.RELEVANCE_CUT) -> DataFrame:
    """Scored posts at or above the cut."""
    return score_relevance(df, rules).where(F.col("relevance_score") >= cut)


def sort_by_relevance(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("relevance_score"), F.asc("id"))
