"""Scoring posts with a model function the caller supplies, resumable by id."""

from __future__ import annotations

import logging
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future
from concurrent.futures import TimeoutError as FutureTimeout
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.numeric import clamp
from forumlens.functions.text import WORD, squeeze, strip, truncate_with_mark
from forumlens.operators.ranking import top_n_per_group
from forumlens.session import write_and_read

ScoreFunction = Callable[[list[str]], list[str]]
_log = logging.getLogger(__name__)

#: Appends of a scoring run; what a run that stops loses is one of them.
SCORE_BUCKETS = 16
# Fewer comments than this always decide a roll-up: each adds a separator of three characters.
ROLLUP_COMMENTS = fixed.COMMENTS_CHARS // len(fixed.COMMENT_SEPARATOR) + 2


@dataclass(frozen=True)
class Prompt:
    """Instruction text around the post; the caller words it for the model in use."""

    before: str = (
        "Judge how closely this forum post concerns moving, transforming and integrating data.\n"
        "70-100: pipelines, connectors, warehouses, integration work and their difficulties.\n"
        "40-69: general analytics, databases, cloud platforms, orchestration.\n"
        "0-39: anything else.\n\n"
    )
    after: str = "\n\nAnswer with one number from 0 to 100 and nothing else."


# ---- comment roll-up -----------------------------------------------------------------------
def clean_comment(body: Column) -> Column:
    """Line breaks, also those written out as backslash and letter, become blanks; blanks squeezed."""
    text = F.replace(F.replace(strip(body), F.lit("\\n"), F.lit(" ")), F.lit("\\r"), F.lit(" "))
    return squeeze(text)


def _long_enough(body: Column) -> Column:
    return F.coalesce(F.char_length(strip(body)) > 5, F.lit(False))


def comment_rollup() -> Column:
    """All nested comments longer than five characters, joined, cut at the limit with a mark."""
    bodies = F.filter(F.transform("comments", lambda c: c["body"]), _long_enough)
    joined = F.array_join(F.transform(bodies, clean_comment), fixed.COMMENT_SEPARATOR)
    return F.coalesce(truncate_with_mark(joined, fixed.COMMENTS_CHARS, fixed.TRUNCATION_MARK), F.lit(""))


def comment_rollup_flat(comments: DataFrame, order: list[str]) -> DataFrame:
    """The same from flat comments, in ``order`` within each post, without gathering whole threads.

    What the limit cuts off is settled by a bounded head: from the separators alone, that many
    comments exceed the limit, and of one body no more than the limit can show.
    """
    kept = comments.where(_long_enough(F.col("body"))).select("post_id", *order, "body")
    head = top_n_per_group(
        kept, ["post_id"], [F.col(c).asc() for c in order], ROLLUP_COMMENTS, rank_name="place"
    )
    shown = F.left(clean_comment(F.col("body")), F.lit(fixed.COMMENTS_CHARS + 1))
    parts = F.array_sort(F.collect_list(F.struct("place", shown.alias("text"))))
    joined = head.groupBy("post_id").agg(parts.alias("_parts")).withColumn(
        "_joined", F.array_join(F.col("_parts.text"), fixed.COMMENT_SEPARATOR)
    )
    text = truncate_with_mark(F.col("_joined"), fixed.COMMENTS_CHARS, fixed.TRUNCATION_MARK)
    return joined.select("post_id", text.alias("comment_text"))


# ---- prompt and reply ----------------------------------------------------------------------
def scoring_prompt(comment_text: Column, prompt: Prompt | None = None) -> Column:
    prompt = prompt or Prompt()
    content = F.left(F.coalesce(F.col("selftext"), F.lit("")), F.lit(fixed.CONTENT_CHARS))
    return F.concat(
        F.lit(prompt.before),
        F.lit("Title: "), F.left(F.coalesce(F.col("title"), F.lit("")), F.lit(fixed.TITLE_CHARS)),
        F.lit("\nContent: "), F.when(content == "", fixed.NO_CONTENT).otherwise(content),
        F.lit("\nComments: "),
        F.when(F.coalesce(comment_text, F.lit("")) == "", fixed.NO_COMMENTS).otherwise(comment_text),
        F.lit(prompt.after),
    )


def parse_score(reply: Column) -> Column:
    """The first free-standing number of up to three digits, limited to 0-100; 50 without one."""
    found = F.regexp_extract(reply, rf"(?<![{WORD}])(\d{{1,3}})(?![{WORD}])", 1)
    number = F.nullif(found, F.lit("")).try_cast("double")
    return F.coalesce(clamp(number, 0, 100), F.lit(fixed.DEFAULT_MODEL_SCORE))


@dataclass(frozen=True)
class Calls:
    """How a task asks the model: prompts per call, calls in flight at once, and seconds until a call counts as failed."""

    prompts: int = 32
    in_flight: int = 4
    timeout: float = 45.0


class _Asking:
    """The calls of one task. A call that doesn't come back keeps its thread; of such threads there are few.

    A batch of prompts that raises is asked again in halves, down to single prompts; one that times out is not, as
    each half could take as long again. When as many calls hang as may be in flight, the model is taken for dead
    and the rest of the task fails at once.
    """

    def __init__(self, score: ScoreFunction, calls: Calls):
        self.score, self.calls, self.hanging = score, calls, []

    def replies(self, prompts: list[str]) -> list[str | None]:
        out: list[str | None] = [None] * len(prompts)
        size = max(1, self.calls.prompts)
        waiting = deque(range(low, min(low + size, len(prompts))) for low in range(0, len(prompts), size))
        running: deque[tuple[range, Future, float]] = deque()
        problem = ""
        while waiting or running:
            self.hanging = [f for f in self.hanging if not f.done()]
            while waiting and len(running) + len(self.hanging) < self.calls.in_flight:
                some = waiting.popleft()
                running.append((some, self._call([prompts[i] for i in some]), time.monotonic() + self.calls.timeout))
            if not running:
                problem = f"{len(self.hanging)} calls hang, {sum(map(len, waiting))} prompts were not asked"
                break
            some, future, deadline = running.popleft()
            try:
                found = future.result(max(0.0, deadline - time.monotonic()))
                if len(found) != len(some):
                    raise ValueError(f"{len(found)} replies to {len(some)} prompts")
                for i, reply in zip(some, found, strict=True):
                    out[i] = reply
            except FutureTimeout:
                self.hanging.append(future)
                problem = f"no reply in {self.calls.timeout} seconds"
            except Exception as error:
                problem = repr(error)
                if len(some) > 1:
                    half = some.start + len(some) // 2
                    waiting.extendleft([range(half, some.stop), range(some.start, half)])
        if None in out:
            _log.warning("no score for %d of %d prompts, last: %s", out.count(None), len(out), problem)
        return out

    def _call(self, prompts: list[str]) -> Future:
        future: Future = Future()

        def run() -> None:
            try:
                future.set_result(list(self.score(prompts)))
            except BaseException as error:
                future.set_exception(error)

        threading.Thread(target=run, daemon=True).start()
        return future


def reply_column(prompt: Column, score: ScoreFunction, calls: Calls | None = None) -> Column:
    """Replies to a column of prompts, several calls at a time; only the prompt travels to Python.

    What raises or doesn't come back in time is logged and null.
    """
    calls = calls or Calls()

    def replies(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        asking = _Asking(score, calls)
        for batch in batches:
            yield pd.Series(asking.replies(batch.tolist()) if len(batch) else [], dtype="object")

    replies.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(replies, "string").asNondeterministic()(prompt)


def score_posts(df: DataFrame, score: ScoreFunction, prompt: Prompt | None = None, calls: Calls | None = None) -> DataFrame:
    """Adds ``llm_relevance_score`` and ``score_status`` (scored or failed) to posts with comments."""
    text = comment_rollup() if "comments" in df.columns else F.lit("")
    asked = df.withColumn("_reply", reply_column(scoring_prompt(text, prompt), score, calls))
    failed = F.col("_reply").isNull()
    return asked.withColumns(
        {
            "llm_relevance_score": parse_score(F.coalesce(F.col("_reply"), F.lit(""))),
            "score_status": F.when(failed, "failed").otherwise("scored"),
        }
    ).drop("_reply")


# ---- resuming ------------------------------------------------------------------------------
def not_yet_scored(df: DataFrame, scored: DataFrame) -> DataFrame:
    """Posts without a score in the scored table; failed ones count as not scored."""
    done = scored
    if "score_status" in scored.columns:
        done = scored.where(F.col("score_status") == "scored")
    done = done.where(F.col("llm_relevance_score").isNotNull())
    return df.join(done.select("id"), "id", "left_anti")


def latest_scores(scored: DataFrame) -> DataFrame:
    """One row per id of an append-only score table: a scored one if there is any."""
    good = F.when(F.col("score_status") == "scored", F.col("llm_relevance_score"))
    return scored.groupBy("id").agg(
        F.coalesce(F.max(good), F.lit(fixed.DEFAULT_MODEL_SCORE)).alias("llm_relevance_score"),
        F.when(F.max(good).isNotNull(), "scored").otherwise("failed").alias("score_status"),
    )


@dataclass(frozen=True)
class Progress:
    """How far a scoring run is: posts with a score now, of those the ones new in this run and from before, and their mean."""

    scored: int
    new: int
    cached: int
    failed: int
    average: float


def score_table(
    df: DataFrame, score: ScoreFunction, scored_path: str, prompt: Prompt | None = None, buckets: int = SCORE_BUCKETS,
    calls: Calls | None = None, report: Callable[[Progress], None] | None = None,
) -> DataFrame:
    """Score what the table at ``scored_path`` lacks, append it there, and rank all posts.

    Posts are scored in ``buckets`` by a hash of their id, and each bucket is an append of its own: a run that
    stops half-way loses the bucket in hand, and the next one goes on with the rest. ``report`` is told after
    each bucket; its numbers are observed while the bucket is written, so nothing is read again for them. Posts
    still without a score take the default.
    """
    spark = df.sparkSession
    schema = "id string, llm_relevance_score double, score_status string"
    spark.createDataFrame([], schema).write.mode("append").parquet(scored_path)
    before = spark.read.schema(schema).parquet(scored_path)
    todo = write_and_read(not_yet_scored(df, before), "to-score")
    cached, total = 0, 0.0
    if report:
        done = latest_scores(before).where("score_status = 'scored'").join(df.select("id").distinct(), "id", "left_semi")
        cached, total = done.agg(F.count(F.lit(1)), F.coalesce(F.sum("llm_relevance_score"), F.lit(0.0))).first()
    new, failed = 0, 0
    for bucket in range(buckets):
        mine = todo.where(F.pmod(F.xxhash64("id"), F.lit(buckets)) == bucket)
        fresh = score_posts(mine, score, prompt, calls).select("id", "llm_relevance_score", "score_status")
        seen, good = Observation(), F.col("score_status") == "scored"
        if report:
            fresh = fresh.observe(
                seen, F.count_if(good).alias("new"), F.count_if(~good).alias("failed"),
                F.coalesce(F.sum(F.when(good, F.col("llm_relevance_score"))), F.lit(0.0)).alias("total"),
            )
        fresh.write.mode("append").parquet(scored_path)
        if report:
            new, failed, total = new + seen.get["new"], failed + seen.get["failed"], total + seen.get["total"]
            report(Progress(cached + new, new, cached, failed, total / max(1, cached + new)))
    scores = latest_scores(spark.read.schema(schema).parquet(scored_path))
    ranked = df.drop("llm_relevance_score", "score_status").join(scores, "id", "left")
    return rank_by_model_score(ranked)


def rank_by_model_score(df: DataFrame) -> DataFrame:
    filled = F.coalesce(F.col("llm_relevance_score"), F.lit(fixed.DEFAULT_MODEL_SCORE))
    return df.withColumn("llm_relevance_score", filled).orderBy(F.desc("llm_relevance_score"), F.asc("id"))
