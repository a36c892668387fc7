"""Whole runs over landed tables: collect, report, write, analyse; resumable step by step.

A run has a folder. A collection is cut into steps of a few subreddits or users. Each step is a table of its
own, and only when that is written is a line about it published in the run's log; readers follow the log. A run that
was stopped goes on with the first step the log lacks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.operators import reports
from forumlens.operators.collect import (
    age_hours, attach_comments, project_comments, project_posts, project_user_comments, tiered_collection, top_comments, user_stats,
)
from forumlens.operators.search import add_search_fields
from forumlens.plans.analysis import STRICT, Analysis, Settings, analyze_combined, save_frames
from forumlens.plans.collection import SearchSettings, daily_report, search_collection, search_report, tier_place, user_collection
from forumlens.session import list_folder, path_exists, publish, read_published
from forumlens.sources.files import write_csv

STEP_SUBREDDITS = 8


# ---- steps ---------------------------------------------------------------------------------
@dataclass(frozen=True)
class Step:
    """What one step is about, and how many rows it wrote."""

    name: str
    keys: list[str]
    rows: int


class Run:
    """The steps of a run in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def finished(self) -> list[Step]:
        """The log, in order of the steps' names."""
        log = f"{self.folder}/log"
        names = [p.rsplit("/", 1)[-1] for p in list_folder(self.spark, log)] if path_exists(self.spark, log) else []
        return [Step(**json.loads(read_published(self.spark, f"{log}/{n}"))) for n in names if n.endswith(".json")]

    def step(self, name: str, keys: list[str], make: Callable[[], DataFrame]) -> None:
        """Write a step's table and publish it, unless the log has it."""
        place = f"{self.folder}/log/{name}.json"
        if path_exists(self.spark, place):
            return
        table = f"{self.folder}/steps/{name}"
        make().write.mode("overwrite").parquet(table)
        rows = self.spark.read.parquet(table).count()
        publish(self.spark, place, json.dumps({"name": name, "keys": keys, "rows": rows}))

    def rows(self) -> DataFrame:
        """The rows of all finished steps, in one frame; at least one has to be finished."""
        return self.spark.read.parquet(*[f"{self.folder}/steps/{s.name}" for s in self.finished()])

    def progress(self) -> DataFrame:
        """(step, subreddits, rows, total): the log as a frame, with the rows collected up to each step."""
        done, total, lines = self.finished(), 0, []
        for step in done:
            total += step.rows
            lines.append((step.name, step.keys, step.rows, total))
        return self.spark.createDataFrame(lines, "step string, subreddits array<string>, rows bigint, total bigint")


def _written(frame: DataFrame, reports_: Mapping[str, DataFrame], folder: str, name: str, form: str) -> str:
    """A collection as a file of the exchange format, and its reports; gives the collection's path."""
    path = f"{folder}/{name}.{form}"
    if form == "csv":
        write_csv(frame, path)
    elif form == "parquet":
        frame.write.parquet(path)
    else:
        raise ValueError(f"unknown form: {form}")
    save_frames(reports_, f"{folder}/reports/{name}")
    return path


# ---- collections ---------------------------------------------------------------------------
def daily_job(
    posts: DataFrame, comments: DataFrame | None, folder: str, as_of: float, tiers: Mapping[str, Mapping] = fixed.TIERS,
    max_comments: int = 200, step_subreddits: int = STEP_SUBREDDITS, form: str = "parquet", name: str = "daily_collection",
) -> str:
    """The tiered collection of a feed as it lands, step by step, with its reports; gives the path of the collection.

    Posts and comments are landed rows, before any projection. Steps take a few subreddits of one tier each. The
    collection is written in the order of the tiers, so that a post of several tiers is first met in the first.
    """
    run = Run(posts.sparkSession, f"{folder}/runs/{name}")
    listed = posts.withColumn("hours_ago", age_hours(F.col("created_utc"), as_of))
    for place, (tier, setting) in enumerate(tiers.items()):
        for low in range(0, len(setting["subreddits"]), step_subreddits):
            some = setting["subreddits"][low : low + step_subreddits]
            run.step(
                f"{place:03d}-{low:05d}", some,
                lambda tier=tier, setting=setting, some=some: _tier_step(listed, comments, as_of, tier, {**setting, "subreddits": some}, max_comments),
            )
    collected = run.rows().orderBy(tier_place(tiers), "subreddit", F.desc("score"), "id")
    frames = {**daily_report(collected, tiers), "progress": run.progress()}
    return _written(collected, frames, folder, name, form)


def _tier_step(posts: DataFrame, comments: DataFrame | None, as_of: float, tier: str, setting: Mapping, max_comments: int) -> DataFrame:
    own = posts.where(F.col("subreddit").isin(list(setting["subreddits"])))
    best = tiered_collection(own, {tier: setting})
    added = ["activity_tier", "tier_description", "target_posts"]
    shaped = project_posts(best, as_of, "top", setting["time_filter"], also=added)
    return with_comments(shaped, comments, max_comments)


def with_comments(posts: DataFrame, comments: DataFrame | None, max_comments: int, max_age_hours: float | None = None, as_of: float | None = None) -> DataFrame:
    """Posts with their best landed comments in the shape of a listing; those of other posts are dropped before any ranking."""
    if comments is None:
        return attach_comments(posts, None)
    own = comments.join(posts.select(F.col("id").alias("post_id")).distinct(), "post_id", "left_semi")
    return attach_comments(posts, top_comments(project_comments(own), max_comments, max_age_hours, as_of))


def search_job(
    posts: DataFrame, comments: DataFrame | None, folder: str, as_of: float, search: SearchSettings | None = None,
    form: str = "parquet", name: str = "hybrid_search",
) -> str:
    """The hybrid search over a feed as it lands, with its reports; gives the path of the collection."""
    run = Run(posts.sparkSession, f"{folder}/runs/{name}")
    run.step("search", [], lambda: _search_step(posts, comments, as_of, search))
    found = run.rows()
    return _written(found, search_report(found), folder, name, form)


def _search_step(posts: DataFrame, comments: DataFrame | None, as_of: float, search: SearchSettings | None) -> DataFrame:
    shaped = add_search_fields(project_posts(posts, as_of, "relevance", "month").drop("sort_type", "time_filter"))
    shown = None if comments is None else project_comments(comments)
    return search_collection(shaped, shown, as_of, search)


def user_job(comments: DataFrame, users: list[str], folder: str, as_of: float, limit: int = 1000, name: str = "users") -> str:
    """The named users' landed comments, a folder per user, with statistics per user and over all; gives the path."""
    run = Run(comments.sparkSession, f"{folder}/runs/{name}")
    run.step("users", list(users), lambda: user_collection(project_user_comments(comments, as_of), users, limit)[0])
    collected = run.rows()
    path = f"{folder}/{name}"
    write_csv(collected, path, ["target_username"])
    stats = user_stats(collected, users)
    save_frames({"user_stats": stats, "overview": reports.user_overview(collected)}, f"{folder}/reports/{name}")
    return path


def whole_job(
    posts: DataFrame, comments: DataFrame | None, folder: str, as_of: float, kind: str = "both", tiers: Mapping[str, Mapping] = fixed.TIERS,
    search: SearchSettings | None = None, settings: Settings = STRICT, form: str = "parquet", unfiltered: bool = False,
) -> Analysis:
    """Collect daily posts, search results or both from landed tables, analyse them together, and write results and reports."""
    if kind not in ("daily", "search", "both"):
        raise ValueError(f"unknown kind: {kind}")
    paths = []
    if kind in ("daily", "both"):
        paths.append(daily_job(posts, comments, folder, as_of, tiers, form=form))
    if kind in ("search", "both"):
        paths.append(search_job(posts, comments, folder, as_of, search, form=form))
    result = analyze_combined(posts.sparkSession, paths, settings)
    result.save(f"{folder}/combined_analyzed_", unfiltered=unfiltered)
    result.save_report(f"{folder}/reports/combined")
    return result
