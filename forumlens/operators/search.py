"""Keyword search over landed posts, alone, for several keywords, and in the hybrid form.

A query matches a post when each of its words is a whole word of title or body. ``relevance``
orders by the number of occurrences of those words; the remote ranking itself is not known.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.lookup import config_table, keyed_lookup
from forumlens.functions.text import combined_text, computed_once, contains_any, matching, matching_places, padded_words
from forumlens.operators.collect import attach_comments, in_window, top_comments
from forumlens.operators.ranking import top_n_per_group
from forumlens.session import write_and_read

#: Terms that are tested one by one; the terms of a longer plan are looked up by the words of the text.
BRANCH_TERMS = 200


def query_words(query: str) -> list[str]:
    words = [w for w in re.split(r"\W+", query.lower()) if w]
    if not words:
        raise ValueError("a query needs at least one word")
    return list(dict.fromkeys(words))


def occurrences(padded: Column, word: str) -> Column:
    """How often the whole word stands in a padded text."""
    needle = f" {word} "
    removed = F.char_length(padded) - F.char_length(F.replace(padded, F.lit(needle), F.lit("")))
    return (removed / F.lit(len(needle))).cast("bigint")


def _all_words(padded: Column, words: list[str]) -> Column:
    return F.forall(F.array(*[F.lit(f" {w} ") for w in words]), lambda w: F.contains(padded, w))


def _hits(padded: Column, words: list[str]) -> Column:
    total = occurrences(padded, words[0])
    for word in words[1:]:
        total = total + occurrences(padded, word)
    return total


def _tested_terms(padded: Column, terms: list[str]) -> Column:
    """array<struct<term_ord, term, occurrences>> of the terms a padded text matches, in plan order; a branch per term."""
    found = [
        F.when(
            _all_words(padded, query_words(term)),
            F.struct(
                F.lit(place).alias("term_ord"), F.lit(term).alias("term"),
                _hits(padded, query_words(term)).alias("occurrences"),
            ),
        )
        for place, term in enumerate(terms)
    ]
    return F.array_compact(F.array(*found))


def _looked_up_terms(padded: Column, terms: list[str]) -> Column:
    """The same for plans of any length: a word of the text leads to the terms of which it is the longest word."""
    by_word: dict[str, list[dict]] = {}
    for place, term in enumerate(terms):
        words = query_words(term)
        by_word.setdefault(max(words, key=len), []).append({"term_ord": place, "term": term, "words": words})
    look_up = keyed_lookup(by_word, "array<struct<term_ord:int,term:string,words:array<string>>>")
    candidates = F.flatten(F.array_compact(F.transform(F.array_distinct(F.split(padded, " ")), look_up)))

    def needle(word: Column) -> Column:
        return F.concat(F.lit(" "), word, F.lit(" "))

    def hits(total: Column, word: Column) -> Column:
        removed = F.char_length(padded) - F.char_length(F.replace(padded, needle(word), F.lit("")))
        return total + (removed / (F.char_length(word) + 2)).cast("bigint")

    fitting = F.filter(candidates, lambda t: F.forall(t["words"], lambda w: F.contains(padded, needle(w))))
    counted = F.transform(
        fitting,
        lambda t: F.struct(
            t["term_ord"].alias("term_ord"), t["term"].alias("term"),
            F.aggregate(t["words"], F.lit(0).cast("bigint"), hits).alias("occurrences"),
        ),
    )
    return F.array_sort(counted)


ORDER_COLUMNS = ("score", "created_utc", "num_comments", "hours_ago")
HIT_COLUMNS = ("term_ord", "term", "occurrences", "location_ord", "search_subreddit", "location_name", "search_rank")
SORT_ORDERS = {
    "relevance": [F.desc, ["occurrences", "score"]],
    "new": [F.desc, ["created_utc"]],
    "top": [F.desc, ["score"]],
    "comments": [F.desc, ["num_comments"]],
}


def _order(sort: str) -> list[Column]:
    if sort not in SORT_ORDERS:
        raise ValueError(f"Invalid sort: {sort}")
    direction, names = SORT_ORDERS[sort]
    return [direction(name) for name in names] + [F.asc("id")]


def _search_terms(
    posts: DataFrame, terms: list[str], sort: str, time_filter: str, limit: int,
    locations: list[tuple[str | None, str]], max_age_hours: float | None,
) -> DataFrame:
    """The results of every (location, term) search, in one pass over the posts and one for their texts."""
    return _fetched(posts, _hits_of(posts, terms, sort, time_filter, limit, locations, max_age_hours))


def _hits_of(
    posts: DataFrame, terms: list[str], sort: str, time_filter: str, limit: int,
    locations: list[tuple[str | None, str]], max_age_hours: float | None,
) -> DataFrame:
    """The hits of every search, written out: post id and content hash, and the search.

    Each post lists the terms it matches and the locations it lies in; only matches are expanded,
    so no pairing of posts with the plan is ever formed. What is shuffled and ranked are ids and sort keys; texts
    are fetched for the hits alone, of which there are at most searches x limit.
    """
    if sort == "top":
        posts = posts.where(in_window(F.lit(time_filter), F.col("hours_ago")))
    keys = ["id", "_row", *[c for c in ORDER_COLUMNS if c in posts.columns]]
    match = _tested_terms if len(terms) <= BRANCH_TERMS else _looked_up_terms
    matched = _matched(_keyed(posts), terms, match(F.col("_padded"), terms), [*keys, "subreddit"])
    places = [
        {"location_ord": place, "search_subreddit": subreddit, "location_name": name}
        for place, (subreddit, name) in enumerate(locations)
    ]
    own_locations = F.filter(
        F.from_json(
            F.lit(json.dumps(places)),
            "array<struct<location_ord:int,search_subreddit:string,location_name:string>>",
        ),
        lambda l: l["search_subreddit"].isNull() | (l["search_subreddit"] == F.col("subreddit")),
    )
    expanded = (
        matched.select("*", F.inline("_terms")).drop("_terms").withColumn("_locations", own_locations)
        .select(*keys, "term_ord", "term", "occurrences", F.inline("_locations"))
    )
    found = top_n_per_group(
        expanded, ["location_ord", "term_ord"], _order(sort), limit, rank_name="search_rank"
    )
    if max_age_hours is not None:
        found = found.where(F.col("hours_ago") <= max_age_hours)
    return write_and_read(found.select(F.col("id").alias("_hit"), F.col("_row").alias("_hit_row"), *HIT_COLUMNS), "hits")


def _keyed(posts: DataFrame) -> DataFrame:
    return posts.withColumn("_row", F.xxhash64(*posts.columns))


def _fetched(posts: DataFrame, hits: DataFrame) -> DataFrame:
    """The posts of hits, one row per hit."""
    same = (F.col("_row") == F.col("_hit_row")) & F.col("id").eqNullSafe(F.col("_hit"))
    fetched = _keyed(posts).join(hits.select("_hit", "_hit_row").distinct(), same, "left_semi").dropDuplicates(["id", "_row"])
    return fetched.join(hits, same).select(*posts.columns, *HIT_COLUMNS)


def _matched(posts: DataFrame, terms: list[str], found: Column, columns: list[str]) -> DataFrame:
    """``columns`` and ``_terms`` of the posts that match any of the terms.

    The longest word of a term has to be somewhere in a text before its words are told apart, which is the dear part.
    """
    rarest = list(dict.fromkeys(max(query_words(t), key=len) for t in terms))
    likely = posts.where(contains_any(F.lower(combined_text()), rarest)) if len(rarest) <= BRANCH_TERMS else posts
    padded = computed_once(likely, {"_padded": padded_words(combined_text())})
    return computed_once(padded, {"_terms": found}).select(*columns, "_terms").where(F.size("_terms") > 0)


def keyword_search(
    posts: DataFrame, query: str, sort: str = "relevance", time_filter: str = "all", limit: int = 100,
    subreddit: str | None = None, max_age_hours: float | None = fixed.SEARCH_WINDOW_HOURS,
) -> DataFrame:
    """One query: the first ``limit`` matches in the sort order, of which those in the window stay."""
    return multi_keyword_search(posts, [query], sort, time_filter, limit, subreddit, max_age_hours)


def multi_keyword_search(
    posts: DataFrame, keywords: list[str], sort: str = "relevance", time_filter: str = "all", limit: int = 100,
    subreddit: str | None = None, max_age_hours: float | None = fixed.SEARCH_WINDOW_HOURS,
) -> DataFrame:
    """Several queries; a post found by more than one belongs to the first."""
    location = (subreddit, f"r/{subreddit}" if subreddit else fixed.EVERYWHERE)
    found = _search_terms(posts, keywords, sort, time_filter, limit, [location], max_age_hours)
    first = top_n_per_group(found, ["id"], [F.asc("term_ord")], 1)
    window = F.lit(time_filter if sort == "top" else None).cast("string")
    return first.withColumns({"search_sort": F.lit(sort), "search_time_filter": window}).withColumnRenamed(
        "term", "search_query"
    ).drop("location_ord", "location_name", "term_ord")


def search_locations(subreddits: list[str] | None) -> list[tuple[str | None, str]]:
    return [(s, f"r/{s}") for s in subreddits or []] + [(None, fixed.EVERYWHERE)]


def search_candidates(
    posts: DataFrame, broad_terms: list[str], subreddits: list[str] | None = None, limit_per_term: int = 100,
    max_age_hours: float | None = fixed.SEARCH_WINDOW_HOURS,
) -> DataFrame:
    """Results of the whole plan, one row per (location, term, post)."""
    return _search_terms(
        posts, broad_terms, "relevance", "month", limit_per_term, search_locations(subreddits), max_age_hours
    )


def search_plan(posts: DataFrame, broad_terms: list[str], subreddits: list[str] | None = None) -> DataFrame:
    """Every (location, term) search with the number of posts it matches, none included.

    Posts give the terms they match, summed by term and subreddit before anything is shuffled; the plan is joined to
    these few sums, whatever its length.
    """
    match = _tested_terms if len(broad_terms) <= BRANCH_TERMS else _looked_up_terms
    matched = _matched(posts, broad_terms, match(F.col("_padded"), broad_terms), ["subreddit"])
    sums = matched.select("subreddit", F.inline("_terms")).groupBy("subreddit", "term_ord").agg(F.count(F.lit(1)).alias("n"))
    sums = write_and_read(sums, "term-sums")
    everywhere = sums.groupBy("term_ord").agg(F.sum("n").alias("n")).withColumn("subreddit", F.lit(None).cast("string"))
    counts = sums.where(F.col("subreddit").isNotNull()).unionByName(everywhere, allowMissingColumns=True).withColumnsRenamed({"subreddit": "_s", "term_ord": "_t"})
    rows = [
        {"location_ord": place, "subreddit": subreddit, "location_name": name, "term_ord": term_ord, "term": term}
        for place, (subreddit, name) in enumerate(search_locations(subreddits)) for term_ord, term in enumerate(broad_terms)
    ]
    plan = config_table(posts.sparkSession, rows, "location_ord int, subreddit string, location_name string, term_ord int, term string")
    joined = plan.join(counts, (F.col("_t") == F.col("term_ord")) & F.col("_s").eqNullSafe(F.col("subreddit")), "left")
    return joined.select(*plan.columns, F.coalesce("n", F.lit(0)).cast("bigint").alias("candidates"))


def hybrid_match(posts: DataFrame, target_keywords: list[str]) -> DataFrame:
    """Posts whose title, body or any nested comment holds a target keyword, with match labels."""
    keywords = [k.lower() for k in target_keywords]
    bodies = F.transform(F.coalesce(F.col("comments"), F.array()), lambda c: F.lower(c["body"]))
    apart = "\0"  # between bodies, so that no keyword reaches from one into the next
    places = computed_once(
        posts, {"_post": matching_places(F.lower(combined_text()), keywords), "_comments": matching_places(F.array_join(bodies, apart), keywords)}
    )
    flagged = places.withColumns({"found_in_post": F.size("_post") > 0, "found_in_comments": F.size("_comments") > 0})
    found = flagged.where(F.col("found_in_post") | F.col("found_in_comments"))
    either = F.array_sort(F.array_union("_post", "_comments"))
    words = F.from_json(F.lit(json.dumps(keywords)), "array<string>")
    return found.withColumn("matched_keywords", F.transform(either, lambda i: F.get(words, i))).drop("_post", "_comments")


def matched_keywords(posts: DataFrame, keywords: list[str]) -> DataFrame:
    """Posts with the list of keywords their own text holds; the list may be empty."""
    return posts.withColumn("matched_keywords", matching(F.lower(combined_text()), [k.lower() for k in keywords]))


def add_search_fields(posts: DataFrame) -> DataFrame:
    """Posts with the fractional days of a search result."""
    return posts.withColumn("days_ago", F.col("hours_ago") / 24.0)


def hybrid_search(
    posts: DataFrame, comments: DataFrame | None, target_keywords: list[str], broad_terms: list[str],
    subreddits: list[str] | None = None, limit_per_term: int = 100, max_comments: int = 200,
    as_of: float | None = None, max_age_hours: float | None = fixed.SEARCH_WINDOW_HOURS,
) -> DataFrame:
    """Broad candidates that hold a target keyword; the first search in plan order names the post.

    Candidates number at most searches * limit, and only their comments are ranked and attached: the comment
    table is cut down by the hits' ids before any shuffle.
    """
    hits = _hits_of(posts, broad_terms, "relevance", "month", limit_per_term, search_locations(subreddits), max_age_hours)
    candidates = _fetched(posts, hits)
    ranked = None
    if comments is not None:
        ids = hits.select(F.col("_hit").alias("post_id")).distinct()
        own = comments.join(ids, "post_id", "left_semi")
        ranked = top_comments(own, max_comments, max_age_hours, as_of)
    matched = hybrid_match(attach_comments(candidates, ranked), target_keywords)
    first = top_n_per_group(matched, ["id"], [F.asc("location_ord"), F.asc("term_ord")], 1)
    return first.withColumnsRenamed({"term": "broad_search_term", "location_name": "search_location"}).withColumns(
        {"search_query": F.col("broad_search_term"), "search_sort": F.lit("relevance")}
    ).drop("location_ord", "term_ord")
