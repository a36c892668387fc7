"""Projections, filters, listings, search, tiers and user histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.catalog.base import (
    AS_OF, LOCATIONS, TARGETS, TERMS, TEXT, TIERS, USERS, Views, any_sql, query, quoted, values_sql,
)
from forumlens.operators import collect, search
from forumlens.operators.ranking import dedupe_posts, duplicate_count
from forumlens.schema import CORE_COLUMNS, harmonize_schema
from forumlens.sources.files import combine_collections, parse_times

PERMALINK = fixed.PERMALINK_BASE


def landed(v: Views) -> DataFrame:
    """Posts as a feed delivers them: relative permalinks, raw flair, some authors missing."""
    return v.posts_with_flags().selectExpr(
        "id", "title", "case when author = '[deleted]' then null else author end as author", "score", "upvote_ratio",
        "num_comments", "created_utc", "concat('https://', subreddit, '.example/', id) as url",
        "concat('/r/', subreddit, '/', id) as permalink", "selftext", "selftext is not null as is_self",
        "concat('self.', subreddit) as domain", "subreddit", "flair_text as link_flair_text", "false as is_video",
        "score > 400 as stickied", "over_18", "false as spoiler", "false as locked",
    )


LANDED_SQL = f"""
 id, title, author, score, upvote_ratio, num_comments, cast(created_utc as double) as created_utc,
 strftime(to_timestamp(created_utc) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as created_datetime, hours_ago,
 'https://' || subreddit || '.example/' || id as url, '{PERMALINK}/r/' || subreddit || '/' || id as permalink, selftext,
 selftext is not null as is_self, 'self.' || subreddit as domain, subreddit, flair_text, false as is_video,
 score > 400 as stickied, over_18, false as spoiler, false as locked, '2024-01-31 00:00:00' as collection_timestamp
"""


def with_text_times(df: DataFrame) -> DataFrame:
    times = ("created_datetime", "collection_timestamp")
    return df.withColumns({c: F.date_format(c, fixed.REPORT_TIME_FORMAT) for c in times if c in df.columns})


@query("project_posts", f"select {LANDED_SQL}, 'top' as sort_type, 'week' as time_filter from posts")
def project_posts(v: Views) -> DataFrame:
    return with_text_times(collect.project_posts(landed(v), AS_OF, "top", "week"))


@query(
    "project_search_posts",
    f"select {LANDED_SQL}, hours_ago / 24e0 as days_ago, 'than' as search_query, 'relevance' as search_sort,"
    " cast(null as varchar) as search_time_filter, cast(null as varchar) as search_subreddit from posts",
)
def project_search_posts(v: Views) -> DataFrame:
    return with_text_times(collect.project_search_posts(landed(v), AS_OF, "than"))


@query(
    "project_comments",
    "select post_id, comment_id, parent_id, author, body, score, cast(created_utc as double) as created_utc,"
    " strftime(to_timestamp(created_utc) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as created_datetime, is_submitter,"
    " false as stickied, cast(depth as int) as depth from comments",
)
def project_comments(v: Views) -> DataFrame:
    return with_text_times(collect.project_comments(v.comments().withColumn("stickied", F.lit(False))))


@query(
    "project_user_comments",
    f"select comment_id, body, cast(length(body) as int) as body_length, author, score,"
    " cast(created_utc as double) as created_utc,"
    " strftime(to_timestamp(created_utc) at time zone 'UTC', '%Y-%m-%d %H:%M:%S UTC') as created_datetime,"
    f" ({AS_OF} - created_utc) / 3600e0 as hours_ago, days_ago, '{PERMALINK}/c/' || comment_id as permalink, subreddit,"
    " case when score % 3 = 0 then '[Unable to fetch post title]' else 'post ' || subreddit end as post_title,"
    " case when score % 3 = 0 then 'unknown' else subreddit end as post_id, 't3_' || comment_id as parent_id,"
    " false as is_submitter, false as stickied, cast(0 as bigint) as gilded, cast(0 as bigint) as controversiality,"
    " score % 5 = 1 as edited, case when score % 5 = 1 then cast(created_utc as double) + 60 end as edited_utc,"
    " '2024-01-31 00:00:00 UTC' as collection_timestamp, 'new' as sort_type from user_comments",
)
def project_user_comments(v: Views) -> DataFrame:
    raw = v.user_comments().selectExpr(
        "comment_id", "body", "author", "score", "created_utc", "subreddit", "concat('/c/', comment_id) as permalink",
        "case when score % 3 <> 0 then concat('post ', subreddit) end as post_title",
        "case when score % 3 <> 0 then subreddit end as post_id", "concat('t3_', comment_id) as parent_id",
        "false as is_submitter", "false as stickied", "cast(0 as bigint) as gilded",
        "cast(0 as bigint) as controversiality",
        "case when score % 5 = 1 then cast(created_utc as double) + 60 end as edited_utc",
    )
    return collect.project_user_comments(raw, AS_OF)


@query(
    "post_age",
    f"select id, ({AS_OF} - created_utc) / 3600e0 as hours_ago, ({AS_OF} - created_utc) / 3600e0 / 24e0 as days_ago,"
    f" cast(floor(({AS_OF} - created_utc) / 86400e0) as bigint) as whole_days,"
    " strftime(to_timestamp(created_utc) at time zone 'UTC', '%Y-%m-%d %H:%M:%S UTC') as created from posts",
)
def post_age(v: Views) -> DataFrame:
    created = F.col("created_utc")
    hours = collect.age_hours(created, AS_OF)
    stamp = F.date_format(F.timestamp_seconds(created), fixed.USER_TIME_FORMAT)
    return v.posts().select(
        "id", hours.alias("hours_ago"), (hours / 24.0).alias("days_ago"),
        collect.age_days(created, AS_OF).alias("whole_days"), stamp.alias("created"),
    )


# ---- harmonising ---------------------------------------------------------------------------
def daily_part(v: Views) -> DataFrame:
    """A tiered collection: without search columns and fractional days."""
    part = v.posts().drop("days_ago")
    return part.selectExpr("*", "'high' as activity_tier", "cast(15 as bigint) as target_posts", "cast(id as bigint) as row_order")


#: Every second post was found under the id that the tiered collection has, the others under one of their own.
SEARCH_ID = "case when cast(id as bigint) % 2 = 0 then id else concat('s', id) end"


def search_part(v: Views) -> DataFrame:
    """A search collection: with a search column, numbers as text where a file would have them so."""
    part = v.posts().drop("score")
    typed = part.selectExpr(
        "*", "case when cast(id as bigint) % 7 = 0 then 'n/a' else concat(cast((cast(id as bigint) * 37) % 500 - 20 as string), '.0') end as score",
        "'than' as search_query", "case when cast(id as bigint) % 4 = 0 then 'True' end as is_self",
        "cast(id as bigint) as row_order",
    )
    return typed.withColumn("id", F.expr(SEARCH_ID))


FLAT_CORE = [c for c, (kind, _) in CORE_COLUMNS.items() if not kind.startswith("array") and kind != "timestamp"]


def _core_sql(given: dict[str, str]) -> str:
    types = {"string": "varchar", "bigint": "bigint", "double": "double", "boolean": "boolean"}
    parts = []
    for name in FLAT_CORE:
        kind, default = CORE_COLUMNS[name]
        value = given.get(name)
        missing = quoted(default) if isinstance(default, str) else str(default).lower()
        parts.append(f"coalesce(cast({value or 'null'} as {types[kind]}), cast({missing} as {types[kind]})) as {name}")
    return ", ".join(parts)


_SHARED = {c: c for c in ("id", "title", "author", "upvote_ratio", "num_comments", "created_utc", "hours_ago", "selftext", "subreddit", "flair_text")}
DAILY_SQL = _core_sql({**_SHARED, "score": "score", "tier": "'high'", "target_posts": "15"})
SEARCH_SQL = _core_sql(
    {
        **_SHARED, "id": SEARCH_ID, "score": "case when cast(id as bigint) % 7 = 0 then null else score end", "days_ago": "days_ago",
        "search_query": "'than'", "is_self": "case when cast(id as bigint) % 4 = 0 then true end",
    }
)
UNITED_SQL = f"""
united as (
 select {DAILY_SQL}, 1 as file_order, cast(id as bigint) as row_order from posts
 union all
 select {SEARCH_SQL}, 2 as file_order, cast(id as bigint) as row_order from posts)
"""


def united(v: Views) -> DataFrame:
    return combine_collections([daily_part(v), search_part(v)])


@query("harmonize_schema", f"select {DAILY_SQL} from posts")
def harmonize(v: Views) -> DataFrame:
    return harmonize_schema(daily_part(v)).select(*FLAT_CORE)


@query(
    "harmonize_nested",
    "select p.id, count(c.comment_id) as n_comments, coalesce(string_agg(c.body, '|' order by comment_rank), '') as bodies,"
    " case when cast(p.id as bigint) % 3 = 0 then 'a,b' else '' end as keywords,"
    " strftime(to_timestamp(any_value(p.created_utc)) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as created_datetime from posts p"
    " left join ranked_comments c on p.id = c.post_id group by p.id",
)
def harmonize_nested(v: Views) -> DataFrame:
    """Lists and times of the core: comments, keywords that are null for most posts, and times given as text."""
    found = F.when(F.col("id").cast("bigint") % 3 == 0, F.array(F.lit("a"), F.lit("b")))
    written = F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM-dd'T'HH:mm:ssXXX")
    core = harmonize_schema(v.nested().withColumns({"matched_keywords": found, "created_datetime": written}))
    return core.select(
        "id", F.size("comments").cast("bigint").alias("n_comments"), F.array_join(F.transform("comments", lambda c: c["body"]), "|").alias("bodies"),
        F.array_join("matched_keywords", ",").alias("keywords"), F.date_format("created_datetime", "yyyy-MM-dd HH:mm:ss").alias("created_datetime"),
    )


@query("coerce_types", f"select {SEARCH_SQL} from posts")
def coerce_types(v: Views) -> DataFrame:
    return harmonize_schema(search_part(v)).select(*FLAT_CORE)


@query("combine_collections", f"select {', '.join(FLAT_CORE)}, file_order, row_order from united", UNITED_SQL)
def combine(v: Views) -> DataFrame:
    return united(v).select(*FLAT_CORE, "file_order", "row_order")


@query(
    "dedupe_posts",
    f"select {', '.join(FLAT_CORE)}, file_order from united"
    " qualify row_number() over (partition by id order by file_order, row_order) = 1",
    UNITED_SQL,
)
def dedupe(v: Views) -> DataFrame:
    return dedupe_posts(united(v), ["file_order", "row_order"]).select(*FLAT_CORE, "file_order")


@query(
    "duplicate_count",
    "select count(*) as total_rows, count(distinct id) as unique_rows, count(*) - count(distinct id) as duplicates from united",
    UNITED_SQL,
)
def duplicates(v: Views) -> DataFrame:
    return duplicate_count(united(v))


@query(
    "parse_times",
    "select id, strftime(to_timestamp(created_utc) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as created_datetime,"
    " cast(null as varchar) as collection_timestamp from posts",
)
def times(v: Views) -> DataFrame:
    raw = v.posts().select(
        "id", F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_datetime"),
        F.lit("no time").alias("collection_timestamp"),
    )
    return with_text_times(parse_times(raw))


# ---- filters and listings ------------------------------------------------------------------
SHORT = "id, subreddit, score, created_utc, hours_ago"


def short(df: DataFrame) -> DataFrame:
    return df.select("id", "subreddit", "score", "created_utc", "hours_ago")


@query("filter_by_age", f"select {SHORT} from posts where hours_ago <= 72")
def filter_by_age(v: Views) -> DataFrame:
    return short(collect.filter_posts_by_age(v.posts()))


@query(
    "newest_posts",
    f"select {SHORT} from posts qualify row_number() over (partition by subreddit order by created_utc desc, id) <= 20",
)
def newest_posts(v: Views) -> DataFrame:
    return short(collect.newest_posts(v.posts(), 20))


@query(
    "top_posts_in_window",
    f"select {SHORT} from posts where hours_ago <= 168"
    " qualify row_number() over (partition by subreddit order by score desc, id) <= 10",
)
def top_posts_in_window(v: Views) -> DataFrame:
    return short(collect.top_posts_in_window(v.posts(), "week", 10))


COMMENT_FIELDS = "post_id, comment_id, author, body, score, comment_rank"


def _top_sql(n: int, where: str = "true") -> str:
    rank = "row_number() over (partition by post_id order by score desc, comment_id)"
    return (
        f"select post_id, comment_id, author, body, score, cast({rank} as int) as comment_rank from comments"
        f" where body <> '[deleted]' and score is not null and {where} qualify {rank} <= {n}"
    )


@query("top_comments", _top_sql(3))
def top_comments(v: Views) -> DataFrame:
    return collect.top_comments(v.comments(), 3).select(*COMMENT_FIELDS.split(", "))


@query("top_comments_recent", _top_sql(3, f"({AS_OF} - created_utc) / 3600e0 <= 336"))
def top_comments_recent(v: Views) -> DataFrame:
    ranked = collect.top_comments(v.comments(), 3, fixed.SEARCH_WINDOW_HOURS, AS_OF)
    return ranked.select(*COMMENT_FIELDS.split(", "))


@query(
    "posts_with_comments",
    "select p.id, cast(count(c.comment_id) as bigint) as comments_collected,"
    " coalesce(string_agg(c.comment_id || ':' || c.score, ',' order by c.comment_rank), '') as comment_list,"
    " coalesce(max(case when comment_rank = 1 then body end), '') as best_body"
    " from posts p left join ranked_comments c on p.id = c.post_id group by p.id",
)
def posts_with_comments(v: Views) -> DataFrame:
    listed = F.transform("comments", lambda c: F.concat_ws(":", c["comment_id"], c["score"].cast("string")))
    return v.nested().select(
        "id", "comments_collected", F.array_join(listed, ",").alias("comment_list"),
        F.coalesce(F.get("comments", F.lit(0))["body"], F.lit("")).alias("best_body"),
    )


# ---- tiers ---------------------------------------------------------------------------------
TIER_ROWS = [
    (tier, s, setting["posts_per_sub"], setting["description"]) for tier, setting in TIERS.items() for s in setting["subreddits"]
]
COLLECTED_SQL = f"""
tier_rows as (select * from {values_sql(TIER_ROWS)} t(tier, subreddit, n, description)),
collected as (
 select p.*, t.tier as activity_tier, t.description as tier_description, cast(t.n as bigint) as target_posts
 from posts p join tier_rows t on p.subreddit = t.subreddit where p.hours_ago <= 168
 qualify row_number() over (partition by t.tier, p.subreddit order by p.score desc, p.id) <= t.n)
"""


def collected(v: Views) -> DataFrame:
    return collect.tiered_collection(v.posts(), TIERS)


@query("tiered_collection", f"select {SHORT}, activity_tier, tier_description, target_posts from collected", COLLECTED_SQL)
def tiered_collection(v: Views) -> DataFrame:
    return collected(v).select(*SHORT.split(", "), "activity_tier", "tier_description", "target_posts")


@query(
    "collection_summary",
    """, targets as (select tier, description, count(*) as subs, sum(n) as target from tier_rows group by all),
    actual as (select activity_tier as tier, count(*) as a from collected group by all),
    per_tier as (select t.*, coalesce(a, 0) as a from targets t left join actual using (tier))
    select tier, upper(tier[1]) || replace(tier, '_', ' ')[2:] as label, description, cast(subs as bigint) as subreddits,
     cast(target as bigint) as target_total, cast(a as bigint) as actual_total from per_tier where tier <> 'very_low'
    union all select tier, 'Very Low', description, cast(subs as bigint), cast(target as bigint), cast(a as bigint)
     from per_tier where tier = 'very_low'
    union all select 'TOTAL', 'TOTAL', null, cast(sum(subs) as bigint), cast(sum(target) as bigint), cast(sum(a) as bigint)
     from per_tier""",
    COLLECTED_SQL,
)
def collection_summary(v: Views) -> DataFrame:
    return collect.collection_summary(collected(v), TIERS)


# ---- search --------------------------------------------------------------------------------
PADDED = rf"' ' || regexp_replace({TEXT}, '[^\p{{L}}\p{{N}}_]+', '  ', 'g') || ' '"


def _occurrences(word: str) -> str:
    return f"cast((length(w) - length(replace(w, ' {word} ', ''))) / {len(word) + 2} as bigint)"


PLAN = [
    (l, None if s == "all" else s, fixed.EVERYWHERE if s == "all" else f"r/{s}", t, term)
    for l, s in enumerate([*LOCATIONS, "all"]) for t, term in enumerate(TERMS)
]
_MATCHES = " or ".join(
    "(t.term = " + quoted(term) + " and " + " and ".join(f"contains(w, ' {x} ')" for x in term.split()) + ")" for term in TERMS
)
_HITS = "case " + " ".join(
    f"when t.term = {quoted(term)} then " + " + ".join(_occurrences(x) for x in term.split()) for term in TERMS
) + " end"
SEARCH_CTES = f"""
padded as (select *, {PADDED} as w from posts),
plan as (select * from {values_sql(PLAN)} t(location_ord, search_subreddit, location_name, term_ord, term)),
paired as (
 select p.* exclude (w), t.*, {_HITS} as occurrences from padded p join plan t
 on (t.search_subreddit is null or t.search_subreddit = p.subreddit) and ({_MATCHES})),
found as (
 select * from paired qualify row_number() over
  (partition by location_ord, term_ord order by occurrences desc, score desc, id) <= 30),
candidates as (select * from found where hours_ago <= 336),
recent_comments as (
 select * from comments where body <> '[deleted]' and ({AS_OF} - created_utc) / 3600e0 <= 336
 qualify row_number() over (partition by post_id order by score desc, comment_id) <= 200),
in_comments as (
 select post_id, {', '.join(f"bool_or(contains(lower(body), {quoted(k.lower())})) as c{i}" for i, k in enumerate(TARGETS))},
  count(*) as comments_collected from recent_comments group by post_id),
matched as (
 select c.*, coalesce(m.comments_collected, 0) as comments_collected, {any_sql(TEXT, [k.lower() for k in TARGETS])} as found_in_post,
  coalesce({' or '.join(f'c{i}' for i in range(len(TARGETS)))}, false) as found_in_comments,
  list_filter([{', '.join(f"case when contains({TEXT}, {quoted(k.lower())}) or coalesce(c{i}, false) then {quoted(k.lower())} end" for i, k in enumerate(TARGETS))}],
   lambda x: x is not null) as matched_keywords
 from candidates c left join in_comments m on c.id = m.post_id),
hybrid as (
 select * from matched where found_in_post or found_in_comments
 qualify row_number() over (partition by id order by location_ord, term_ord) = 1)
"""


@query(
    "search_plan",
    "select cast(t.location_ord as int) as location_ord, t.search_subreddit as subreddit, t.location_name,"
    " cast(t.term_ord as int) as term_ord, t.term, count(p.id) as candidates from plan t left join paired p"
    " on p.location_ord = t.location_ord and p.term_ord = t.term_ord group by all",
    SEARCH_CTES,
)
def search_plan(v: Views) -> DataFrame:
    return search.search_plan(v.posts(), TERMS, LOCATIONS)


@query(
    "keyword_search",
    "select id, subreddit, score, occurrences, hours_ago from found where location_ord = 2 and term_ord = 0 and hours_ago <= 336",
    SEARCH_CTES,
)
def keyword_search(v: Views) -> DataFrame:
    found = search.keyword_search(v.posts(), TERMS[0], limit=30)
    return found.select("id", "subreddit", "score", "occurrences", "hours_ago")


@query(
    "multi_keyword_search",
    "select id, subreddit, score, term as search_query from found where location_ord = 2 and hours_ago <= 336"
    " qualify row_number() over (partition by id order by term_ord) = 1",
    SEARCH_CTES,
)
def multi_keyword_search(v: Views) -> DataFrame:
    return search.multi_keyword_search(v.posts(), TERMS, limit=30).select("id", "subreddit", "score", "search_query")


@query(
    "matched_keywords",
    f"select id, concat_ws(',', {', '.join(f'case when contains({TEXT}, {quoted(k.lower())}) then {quoted(k.lower())} end' for k in TARGETS)})"
    " as matched_keywords from posts",
)
def matched_keywords(v: Views) -> DataFrame:
    return search.matched_keywords(v.posts(), TARGETS).select("id", F.array_join("matched_keywords", ",").alias("matched_keywords"))


ALL_IN_COMMENTS = f"""
seen as (select post_id, {', '.join(f"bool_or(contains(lower(body), {quoted(k.lower())})) as c{i}" for i, k in enumerate(TARGETS))}
 from ranked_comments group by post_id),
labelled as (
 select p.id, {any_sql(TEXT, [k.lower() for k in TARGETS])} as found_in_post,
  coalesce({' or '.join(f'c{i}' for i in range(len(TARGETS)))}, false) as found_in_comments,
  concat_ws(',', {', '.join(f"case when contains({TEXT}, {quoted(k.lower())}) or coalesce(c{i}, false) then {quoted(k.lower())} end" for i, k in enumerate(TARGETS))})
   as matched_keywords
 from posts p left join seen s on p.id = s.post_id)
"""


@query("hybrid_match", "select * from labelled where found_in_post or found_in_comments", ALL_IN_COMMENTS)
def hybrid_match(v: Views) -> DataFrame:
    return search.hybrid_match(v.nested(), TARGETS).select(
        "id", "found_in_post", "found_in_comments", F.array_join("matched_keywords", ",").alias("matched_keywords")
    )


def hybrid(v: Views) -> DataFrame:
    return search.hybrid_search(v.posts(), v.comments(), TARGETS, TERMS, LOCATIONS, 30, 200, AS_OF)


@query(
    "hybrid_search",
    "select id, subreddit, score, term as broad_search_term, location_name as search_location, found_in_post, found_in_comments,"
    " array_to_string(matched_keywords, ',') as matched_keywords, comments_collected from hybrid",
    SEARCH_CTES,
)
def hybrid_search(v: Views) -> DataFrame:
    return hybrid(v).select(
        "id", "subreddit", "score", "broad_search_term", "search_location", "found_in_post", "found_in_comments",
        F.array_join("matched_keywords", ",").alias("matched_keywords"), "comments_collected",
    )


# ---- users ---------------------------------------------------------------------------------
USER_LIST = ", ".join(quoted(u) for u in USERS)
USERS_SQL = f"""
listed as (
 select *, author as target_username from user_comments where author in ({USER_LIST})
 qualify row_number() over (partition by author order by created_utc desc, comment_id) <= 1000),
target_comments as (select * from listed where author is not null and body not in ('[deleted]', '[removed]'))
"""


def target_comments(v: Views) -> DataFrame:
    return collect.collect_user_comments(v.user_comments(), USERS)


@query("user_comments_clean", "select * from user_comments where author is not null and body not in ('[deleted]', '[removed]')")
def user_comments_clean(v: Views) -> DataFrame:
    return collect.drop_removed(v.user_comments())


@query("user_comments", "select * from target_comments", USERS_SQL)
def user_comments(v: Views) -> DataFrame:
    return target_comments(v)


@query(
    "user_stats",
    f""", stats as (
     select target_username, count(*) as total_comments, avg(score) as avg_score, cast(sum(score) as bigint) as total_score,
      avg(length(body)) as avg_length, count(distinct subreddit) as unique_subreddits, max(days_ago) as oldest_comment_days,
      min(days_ago) as newest_comment_days from target_comments group by 1),
    counts as (select target_username, subreddit, count(*) as n from target_comments group by 1, 2
     qualify row_number() over (partition by target_username order by count(*) desc, subreddit) <= 5),
    best as (select target_username, string_agg(subreddit || ':' || n, ',' order by n desc, subreddit) as top_subreddits
     from counts group by 1)
    select u.target_username, coalesce(total_comments, 0) as total_comments, avg_score, total_score, avg_length,
     unique_subreddits, oldest_comment_days, newest_comment_days, top_subreddits
    from {values_sql([(u,) for u in USERS])} u(target_username) left join stats using (target_username)
    left join best using (target_username)""",
    USERS_SQL,
)
def user_stats(v: Views) -> DataFrame:
    stats = collect.user_stats(target_comments(v), USERS)
    entries = F.transform(F.map_entries("top_subreddits"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return stats.withColumn("top_subreddits", F.array_join(entries, ","))
