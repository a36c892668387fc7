"""A training corpus from the documents table: toxicity, near-duplicates, contamination, personal data, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.common import Scratch
from forumlens.llm.contamination import drop_contaminated
from forumlens.llm.mixing import draw
from forumlens.llm.nearcopies import keep_one_of_near_copies
from forumlens.llm.pii import redact_pii, train_field
from forumlens.llm.queries import HELD_OUT, POWERS, table
from forumlens.llm.toxicity import THRESHOLD, fit_toxicity, toxicity_score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score stays below the threshold; the model learns from the labels that are not held out.

    Null and empty texts score like texts without hits; repeated rows and further columns come back as they were.
    """
    labels = table(spark, sf_dir, "labels").where(f"not ({HELD_OUT})").select("doc_id", "toxic")
    return docs.where(toxicity_score(fit_toxicity(docs, labels)) < THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest ``doc_id`` of each group that five-word similarity of 0.8 connects, from SimHash links on.

    Null and blank texts are one group; of repeated rows one stays; further columns come back as they were.
    """
    return keep_one_of_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item's question and answer both stand, nor most of the whole item.

    Null and empty texts stay; repeated rows and further columns come back as they were.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with tags for personal data, and ``n_chars`` of the new text; null texts stay null."""
    masked = redact_pii(docs, train_field())
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows drawn by calibrated rates, with ``copies`` and ``unmet``, what the bound on copies leaves of a target; as many tokens are drawn as there are."""
    return draw(docs, POWERS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("personal_data", mask_personal_data),
    ("source_mixing", mix_sources),
]

#: Learnt scores and fields have no SQL; stage by stage the rows are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again before the next."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
