"""Whole runs over the given tables as landed ones, against SQL: topics are left out, as SQL can't fit them."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.catalog.analytics import SETTINGS, WHOLE_SQL
from forumlens.catalog.base import AS_OF, LOCATIONS, TARGETS, TERMS, TIERS, USERS, Views, query
from forumlens.catalog.collecting import COLLECTED_SQL, SEARCH_CTES, UNITED_SQL, landed, united
from forumlens.catalog.files import stored
from forumlens.operators import collect
from forumlens.operators.ranking import dedupe_posts
from forumlens.plans import analysis, collection, jobs
from forumlens.session import work_folder
from forumlens.sources import files

PLAIN = replace(SETTINGS, topics=0)
RANKED = ["id", "overall_sentiment_score", "overall_sentiment_class", "relevance_score", "engagement_score", "score", "hours_ago"]
RANKED_SQL = f"select {', '.join(RANKED)} from engaged"
SEARCH = collection.SearchSettings(TARGETS, TERMS, LOCATIONS, 30)
STEP = 4


def over(posts: str, comments: str) -> str:
    """The analysis in SQL over other posts and comments than the views'."""
    return re.sub(r"\branked_comments\b", comments, re.sub(r"\bposts\b", posts, WHOLE_SQL))


# ---- analyses ------------------------------------------------------------------------------
@query("analyze_file", RANKED_SQL, WHOLE_SQL)
def analyze_file(v: Views) -> DataFrame:
    """One collection from a CSV file on disk to ranked results."""
    path = f"{work_folder(v.spark, 'one')}.csv"
    files.write_csv(stored(v), path)
    return analysis.analyze_one(v.spark, path, PLAIN).posts.select(*RANKED)


KEPT_SQL = (
    UNITED_SQL + ", kept as (select * from united qualify row_number() over (partition by id order by file_order, row_order) = 1),"
    " no_comments as (select * from ranked_comments where false)," + over("kept", "no_comments")
)


@query("analyze_united", RANKED_SQL, KEPT_SQL)
def analyze_united(v: Views) -> DataFrame:
    """Two overlapping collections, harmonised, united, the first row of each id kept, and analysed."""
    return analysis.analyze(dedupe_posts(united(v), ["file_order", "row_order"]), PLAIN).posts.select(*RANKED)


@query("analyze_folder", RANKED_SQL, KEPT_SQL)
def analyze_folder(v: Views) -> DataFrame:
    """The same from files of two kinds, found in a folder."""
    folder = work_folder(v.spark, "both")
    daily, search = (part.drop("row_order") for part in (_daily(v), _search(v)))
    files.write_csv(daily, f"{folder}/activity_based_1.csv")
    files.write_posts_json(search, f"{folder}/search_1.json")
    return analysis.analyze_folder(v.spark, folder, PLAIN).posts.select(*RANKED)


def _daily(v: Views) -> DataFrame:
    from forumlens.catalog.collecting import daily_part

    return daily_part(v)


def _search(v: Views) -> DataFrame:
    from forumlens.catalog.collecting import search_part

    return search_part(v)


BOTH_SQL = (
    COLLECTED_SQL + "," + SEARCH_CTES
    + """,
shared as (select id, title, selftext, score, upvote_ratio, num_comments, hours_ago, 1 as file_order from collected
 union all select id, title, selftext, score, upvote_ratio, num_comments, hours_ago, 2 from hybrid),
kept as (select * from shared qualify row_number() over (partition by id order by file_order) = 1),
kept_comments as (
 select c.* from ranked_comments c join kept k on c.post_id = k.id where k.file_order = 1
 union all
 select c.*, row_number() over (partition by post_id order by c.score desc, comment_id) as comment_rank from recent_comments c
 join kept k on c.post_id = k.id where k.file_order = 2),"""
    + over("kept", "kept_comments")
)


@query("collect_and_rank", RANKED_SQL, BOTH_SQL)
def collect_and_rank(v: Views) -> DataFrame:
    """Daily and search collections of the posts, united and analysed."""
    return collection.collect_and_analyze(v.posts(), v.comments(), AS_OF, "both", TIERS, SEARCH, PLAIN).posts.select(*RANKED)


# ---- jobs ----------------------------------------------------------------------------------
def landed_comments(v: Views) -> DataFrame:
    return v.comments().withColumn("stickied", F.lit(False))


@query("whole_job", RANKED_SQL, BOTH_SQL)
def whole_job(v: Views) -> DataFrame:
    """From landed tables to written results, which are read back."""
    folder = work_folder(v.spark, "whole-job")
    jobs.whole_job(landed(v), landed_comments(v), folder, AS_OF, "both", TIERS, SEARCH, PLAIN)
    return v.spark.read.parquet(f"{folder}/combined_analyzed_").select(*RANKED)


@query(
    "daily_job",
    f"select c.id, c.author, '{fixed.PERMALINK_BASE}/r/' || c.subreddit || '/' || c.id as permalink, c.hours_ago, c.activity_tier, c.target_posts,"
    " coalesce(n, 0) as comments_collected from collected c left join (select post_id, count(*) as n from ranked_comments group by 1) m on c.id = m.post_id",
    COLLECTED_SQL,
)
def daily_job(v: Views) -> DataFrame:
    """The tiered collection, projected, written as CSV in steps of a few subreddits, and read back."""
    path = jobs.daily_job(landed(v), landed_comments(v), work_folder(v.spark, "daily-job"), AS_OF, TIERS, step_subreddits=STEP, form="csv")
    back = files.read_posts_csv(v.spark, path)
    return back.select("id", "author", "permalink", "hours_ago", "activity_tier", F.col("target_posts").cast("bigint"), "comments_collected")


@query(
    "daily_job_progress",
    f"""select tier || ':' || cast(step as varchar) as step, rows, sum(rows) over (order by tier_ord, step) as total from (
     select tier_ord, tier, step, count(id) as rows from (
      select t.tier, t.place // {STEP} as step, min(t.tier_ord) over (partition by t.tier) as tier_ord, c.id
      from (select tier, subreddit, row_number() over (partition by tier order by try_cast(regexp_extract(subreddit, '[0-9]+') as int)) - 1 as place,
       case tier when 'high' then 0 when 'medium' then 1 when 'low' then 2 when 'very_low' then 3 else 4 end as tier_ord from tier_rows) t
      left join collected c on c.subreddit = t.subreddit and c.activity_tier = t.tier) group by all)""".replace("sum(rows)", "cast(sum(rows)").replace("tier_ord, step) as total", "tier_ord, step) as bigint) as total"),
    COLLECTED_SQL,
)
def daily_job_progress(v: Views) -> DataFrame:
    """The log of a collection: rows of each step and up to it."""
    folder = work_folder(v.spark, "daily-log")
    jobs.daily_job(landed(v), None, folder, AS_OF, TIERS, step_subreddits=STEP)
    tiers = F.array(*[F.lit(t) for t in TIERS])
    tier = F.get(tiers, F.split("step", "-")[0].cast("int"))
    number = (F.split("step", "-")[1].cast("int") / STEP).cast("int").cast("string")
    return jobs.Run(v.spark, f"{folder}/runs/daily_collection").progress().select(F.concat(tier, F.lit(":"), number).alias("step"), "rows", "total")


@query(
    "search_job",
    "select id, subreddit, score, hours_ago / 24e0 as days_ago, term as broad_search_term, location_name as search_location, found_in_post, found_in_comments,"
    " array_to_string(matched_keywords, ',') as matched_keywords, comments_collected from hybrid",
    SEARCH_CTES,
)
def search_job(v: Views) -> DataFrame:
    """The hybrid search over landed tables, written and read back."""
    path = jobs.search_job(landed(v), landed_comments(v), work_folder(v.spark, "search-job"), AS_OF, SEARCH)
    return v.spark.read.parquet(path).select(
        "id", "subreddit", "score", "days_ago", "broad_search_term", "search_location", "found_in_post", "found_in_comments",
        F.array_join("matched_keywords", ",").alias("matched_keywords"), "comments_collected",
    )


@query(
    "tiered_listing",
    "select id, subreddit, score, activity_tier, target_posts from collected",
    COLLECTED_SQL,
)
def tiered_listing(v: Views) -> DataFrame:
    """The tiered collection from a feed laid out by day and subreddit, of which only the listed folders are opened."""
    path, posts = work_folder(v.spark, "laid-out"), v.posts().select("id", "subreddit", "score", "created_utc")
    collect.write_feed(posts, path)
    return collect.tiered_listing(v.spark, path, posts.schema, AS_OF, TIERS).select("id", "subreddit", "score", "activity_tier", "target_posts")


@query(
    "user_job",
    "select target_username, comment_id, body, score from (select *, author as target_username from user_comments"
    " where author in (" + ", ".join(f"'{u}'" for u in USERS) + ") qualify row_number() over (partition by author order by created_utc desc, comment_id) <= 1000)"
    " where body not in ('[deleted]', '[removed]')",
)
def user_job(v: Views) -> DataFrame:
    """Users' landed comments, written in a folder per user and read back."""
    raw = v.user_comments().selectExpr(
        "comment_id", "body", "author", "score", "created_utc", "subreddit", "concat('/c/', comment_id) as permalink", "subreddit as post_title",
        "subreddit as post_id", "concat('t3_', comment_id) as parent_id", "false as is_submitter", "false as stickied",
        "cast(0 as bigint) as gilded", "cast(0 as bigint) as controversiality", "cast(null as double) as edited_utc",
    )
    path = jobs.user_job(raw, USERS, work_folder(v.spark, "user-job"), AS_OF)
    return files.read_csv(v.spark, path).select("target_username", "comment_id", "body", F.col("score").cast("bigint").alias("score"))
