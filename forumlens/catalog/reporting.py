"""Summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.catalog.analytics import ALL_ENGAGED_SQL, all_engaged
from forumlens.catalog.base import Views, half_even_sql, query
from forumlens.catalog.collecting import COLLECTED_SQL, SEARCH_CTES, USERS_SQL, collected, hybrid, target_comments
from forumlens.operators import reports


def r2(value: str) -> str:
    return half_even_sql(value, 2)


@query(
    "dataset_overview",
    "select count(*) as total_posts, count(distinct subreddit) as unique_subreddits,"
    " strftime(to_timestamp(min(created_utc)) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as first_created,"
    " strftime(to_timestamp(max(created_utc)) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as last_created from posts",
)
def dataset_overview(v: Views) -> DataFrame:
    posts = v.posts().withColumn("created_datetime", F.timestamp_seconds("created_utc"))
    overview = reports.dataset_overview(posts)
    return overview.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_created", "last_created")})


@query(
    "engagement_summary",
    f"select {r2('avg(engagement_score)')} as avg_engagement, {r2('median(engagement_score)')} as median_engagement,"
    " min(engagement_score) as min_engagement, max(engagement_score) as max_engagement,"
    " count(*) filter (engagement_score > 70) as high, count(*) filter (engagement_score between 30 and 70) as medium,"
    " count(*) filter (engagement_score < 30) as low from engaged",
    ALL_ENGAGED_SQL,
)
def engagement_summary(v: Views) -> DataFrame:
    return reports.engagement_summary(all_engaged(v))


STATS_SQL = (
    f"select subreddit, count(score) as post_count, {r2('avg(score)')} as avg_score, {r2('avg(num_comments)')} as avg_comments,"
    f" {r2('avg(engagement_score)')} as avg_engagement from engaged group by subreddit"
)


@query("subreddit_stats", STATS_SQL, ALL_ENGAGED_SQL)
def subreddit_stats(v: Views) -> DataFrame:
    return reports.subreddit_stats(all_engaged(v))


@query("top_subreddits", STATS_SQL + " order by avg_engagement desc, subreddit limit 10", ALL_ENGAGED_SQL)
def top_subreddits(v: Views) -> DataFrame:
    return reports.top_subreddits(all_engaged(v))


@query(
    "top_posts",
    "select id, case when length(title) > 60 then left(title, 60) || '...' else title end as title, subreddit, score,"
    " num_comments, engagement_score from engaged order by engagement_score desc, id limit 10",
    ALL_ENGAGED_SQL,
)
def top_posts(v: Views) -> DataFrame:
    return reports.top_posts(all_engaged(v))


@query(
    "collection_overview",
    f"select count(*) as total_posts, count(distinct subreddit) as unique_subreddits, {r2('avg(score)')} as avg_score,"
    f" {r2('avg(hours_ago)')} as avg_hours_ago from collected",
    COLLECTED_SQL,
)
def collection_overview(v: Views) -> DataFrame:
    return reports.collection_overview(collected(v))


@query(
    "tier_stats",
    f"select activity_tier, count(id) as posts, {r2('avg(score)')} as avg_score, {r2('avg(hours_ago)')} as avg_hours_ago,"
    " count(distinct subreddit) as subreddits from collected group by activity_tier",
    COLLECTED_SQL,
)
def tier_stats(v: Views) -> DataFrame:
    return reports.tier_stats(collected(v))


@query(
    "top_posts_per_tier",
    "select activity_tier, cast(row_number() over w as int) as place, id, subreddit, left(title, 50) || '...' as title, score,"
    " hours_ago from collected window w as (partition by activity_tier order by score desc, id) qualify row_number() over w <= 3",
    COLLECTED_SQL,
)
def top_posts_per_tier(v: Views) -> DataFrame:
    return reports.top_posts_per_tier(collected(v))


@query("posts_per_subreddit", "select subreddit, count(*) as posts from posts group by 1 order by 2 desc, 1")
def posts_per_subreddit(v: Views) -> DataFrame:
    return reports.value_counts(v.posts(), "subreddit")


@query("top_subreddits_found", "select subreddit, count(*) as posts from hybrid group by 1 order by 2 desc, 1 limit 10", SEARCH_CTES)
def top_subreddits_found(v: Views) -> DataFrame:
    return reports.value_counts(hybrid(v), "subreddit", 10)


@query("posts_per_term", "select term as broad_search_term, count(*) as posts from hybrid group by 1", SEARCH_CTES)
def posts_per_term(v: Views) -> DataFrame:
    return reports.value_counts(hybrid(v), "broad_search_term")


@query("posts_per_location", "select location_name as search_location, count(*) as posts from hybrid group by 1", SEARCH_CTES)
def posts_per_location(v: Views) -> DataFrame:
    return reports.value_counts(hybrid(v), "search_location")


@query(
    "keyword_frequency",
    "select keyword, count(*) as mentions from (select unnest(matched_keywords) as keyword from hybrid) group by 1",
    SEARCH_CTES,
)
def keyword_frequency(v: Views) -> DataFrame:
    return reports.keyword_frequency(hybrid(v))


@query(
    "match_type_counts",
    "select count(*) as total, count(*) filter (found_in_post) as in_post, count(*) filter (found_in_comments) as in_comments,"
    " count(*) filter (found_in_post and found_in_comments) as in_both, count(*) filter (comments_collected > 0) as with_comments"
    " from hybrid",
    SEARCH_CTES,
)
def match_type_counts(v: Views) -> DataFrame:
    return reports.match_type_counts(hybrid(v))


@query(
    "comment_totals",
    "select count(*) as total_comments, count(distinct post_id) as posts_with_comments from all_comments"
    " where post_id in (select id from posts)",
)
def comment_totals(v: Views) -> DataFrame:
    return reports.comment_totals_flat(v.posts(), v.valid_comments())


@query(
    "user_overview",
    f"select count(*) as total_comments, count(distinct subreddit) as unique_subreddits, {r2('avg(score)')} as avg_score,"
    f" {half_even_sql('avg(length(body))', 0)} as avg_length, max(days_ago) as oldest_days, min(days_ago) as newest_days"
    " from target_comments",
    USERS_SQL,
)
def user_overview(v: Views) -> DataFrame:
    return reports.user_overview(target_comments(v))


@query("user_top_subreddits", "select subreddit, count(*) as comments from target_comments group by 1 order by 2 desc, 1 limit 10", USERS_SQL)
def user_top_subreddits(v: Views) -> DataFrame:
    return reports.user_top_subreddits(target_comments(v))


@query(
    "recent_user_activity",
    f"select count(*) filter (days_ago <= 14) as recent_comments, count(*) as total_comments,"
    f" {r2('avg(score) filter (days_ago <= 14)')} as recent_avg_score from target_comments",
    USERS_SQL,
)
def recent_user_activity(v: Views) -> DataFrame:
    return reports.recent_user_activity(target_comments(v), 14)
