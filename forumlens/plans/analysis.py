"""Analysis of one collection or several, from landed posts to ranked results.

The order of steps is part of the result: engagement is scaled by the maxima over relevant posts,
so the relevance gate stays before it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.operators.engagement import calculate_engagement
from forumlens.operators.filters import two_tier_filter
from forumlens.operators.ranking import dedupe_posts, final_sort
from forumlens.operators.relevance import RelevanceRules, filter_by_relevance
from forumlens.operators.reports import analysis_report
from forumlens.operators.sentiment import STARTER_LEXICON, Lexicon, add_sentiment
from forumlens.operators.topics import TopicModel, model_topics
from forumlens.session import write_and_read
from forumlens.sources.files import POSITION, find_raw_files, load_collections, load_posts, write_analysis


@dataclass(frozen=True)
class Settings:
    """What an analysis can be told. ``high`` is the score from which posts skip the thresholds."""

    weights: Mapping[str, float] | None = None
    thresholds: Mapping | None = None
    rules: RelevanceRules = field(default_factory=RelevanceRules)
    lexicon: Lexicon = STARTER_LEXICON
    cut: int = fixed.RELEVANCE_CUT
    high: int = fixed.RELEVANCE_CUT
    topics: int = 8
    stop_words: list[str] | None = None
    topic_iterations: int = 200


PRESET = Settings(weights=fixed.PRESET_WEIGHTS, thresholds=fixed.PRESET_THRESHOLDS)
STRICT = Settings(weights=fixed.PRESET_WEIGHTS, thresholds=fixed.STRICT_THRESHOLDS)


@dataclass
class Analysis:
    """The ranked posts, all scored posts before the thresholds, the topic model if one was fitted, and the report frames."""

    posts: DataFrame
    scored: DataFrame
    topics: TopicModel | None = None

    @property
    def report(self) -> dict[str, DataFrame]:
        """The report; with a topic model also each topic's name, heaviest terms and number of posts."""
        report = analysis_report(self.posts)
        if self.topics is not None:
            report["topic_info"] = topic_info(self.posts, self.topics)
            report["topic_terms"] = self.topics.terms(self.posts)
        return report

    def save_report(self, path: str) -> list[str]:
        """Each frame of the report as a table of its own."""
        return save_frames(self.report, path)

    def save(self, path: str, form: str = "parquet", unfiltered: bool = False) -> list[str]:
        written = [write_analysis(self.posts, path, form)]
        if unfiltered:
            written.append(write_analysis(self.scored, f"{path}_unfiltered", form))
        return written


def analyze(posts: DataFrame, settings: Settings = PRESET) -> Analysis:
    """Topics, relevance gate, sentiment, engagement, two tiers, order.

    Topic fitting reads the posts several times and the engagement maxima once more, so the posts
    are written out, with their terms, before the first, and the gated ones before the second. Nothing between those
    points moves a row: topics, relevance and sentiment are computed where the row is. Sentiment is
    the dearest and decides nothing before the order, so only gated posts get it. Without topics the posts have no
    topic columns and are read once.
    """
    labelled, model = posts, None
    if settings.topics:
        labelled, model = model_topics(posts, settings.topics, stop_words=settings.stop_words, max_iter=settings.topic_iterations)
    gated = filter_by_relevance(labelled, settings.rules, settings.cut)
    relevant = write_and_read(add_sentiment(gated, settings.lexicon), "relevant")
    scored = calculate_engagement(relevant, settings.weights)
    kept = two_tier_filter(scored, settings.thresholds, settings.high)
    return Analysis(final_sort(kept), scored, model)


def topic_info(posts: DataFrame, model: TopicModel) -> DataFrame:
    """(topic_id, topic_name, top_words, posts) of every topic, also of those that no post took."""
    counts = posts.where("topic_id >= 0").groupBy("topic_id").agg(F.count(F.lit(1)).alias("posts"))
    joined = model.names(posts).join(counts, "topic_id", "left")
    return joined.withColumn("posts", F.coalesce("posts", F.lit(0)))


def save_frames(frames: Mapping[str, DataFrame], path: str) -> list[str]:
    """Frames as parquet tables below a folder; a table that is there from an earlier attempt is replaced."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
    return [f"{path}/{name}" for name in frames]


def analyze_one(spark: SparkSession, path: str, settings: Settings = PRESET) -> Analysis:
    return analyze(load_posts(spark, path), settings)


def analyze_combined(spark: SparkSession, paths: list[str], settings: Settings = PRESET) -> Analysis:
    """Several files: harmonised, united in file order, the first row of each id kept."""
    united = dedupe_posts(load_collections(spark, paths), ["file_order", POSITION])
    return analyze(united.drop(POSITION), settings)


def analyze_folder(spark: SparkSession, folder: str, settings: Settings = PRESET, forms: tuple[str, ...] = (".csv", ".json", ".parquet")) -> Analysis:
    """All collected files of a folder, daily ones before searches; a folder without any raises."""
    paths = find_raw_files(spark, folder, forms)
    if not paths:
        raise ValueError(f"no collected files in {folder}")
    return analyze_combined(spark, paths, settings)
