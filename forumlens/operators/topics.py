"""Topics of posts: TF-IDF over words and word pairs, factorised, named and assigned."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.batches import by_slices, coded, translated
from forumlens.functions.lookup import config_table
from forumlens.functions.numeric import half_even
from forumlens.functions.text import NON_WORD_PATTERN, ascii_apart, combined_text, computed_once, let, strip
from forumlens.operators.nmf import NmfModel, fit_nmf, sparse_parts
from forumlens.session import write_and_read

MIN_CHARS = 20
WEIGHT_FLOOR = 0.1
TERMS = "_terms"
WORDS = "_words"
#: Frequent-items sketches merged in one task.
SKETCHES_AT_ONCE = 64
#: Words whose pairs are counted, at most; where more are in question, every pair is counted.
MOST_PAIRED = 200_000
#: Texts that are worked through at a time.
TEXTS_AT_ONCE = 1024
COUNTED = pa.list_(pa.struct([pa.field("term", pa.string()), pa.field("n", pa.int32())]))
TALLIED = "n bigint, documents bigint"
VECTOR = pa.struct([pa.field("indices", pa.list_(pa.int32())), pa.field("values", pa.list_(pa.float64()))])


def default_stop_words() -> list[str]:
    """Spark's English list and the domain's own words. Another list is a parameter away."""
    return StopWordsRemover.loadDefaultStopWords("english") + fixed.EXTRA_STOP_WORDS


# ---- terms ----------------------------------------------------------------------------------
def topic_documents(df: DataFrame, key: str = "id") -> DataFrame:
    """Title and body of posts with more than twenty characters."""
    text = strip(combined_text())
    return df.select(key, text.alias("text")).where(F.char_length("text") > MIN_CHARS)


def terms_of(text: Column, stop_words: list[str]) -> Column:
    """Words that are letters and digits from a letter on, without stop words, then their pairs.

    Stop words go first, so a pair may span one.
    """
    words = F.filter(
        F.split(F.lower(text), NON_WORD_PATTERN),
        lambda w: F.rlike(w, F.lit("^[a-z][a-z0-9]+$")) & ~w.isin(stop_words),
    )

    def with_pairs(kept: Column) -> Column:
        pairs = F.transform(kept, lambda w, i: F.concat(w, F.lit(" "), F.get(kept, i + 1)))
        return F.concat(kept, F.array_compact(pairs))

    return let(words, with_pairs)


@dataclass(frozen=True)
class Vocabulary:
    """Kept terms in order, with document frequency, corpus count and inverse document frequency."""

    terms: list[str]
    document_frequency: list[int]
    corpus_count: list[int]
    documents: int

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.documents) / (1 + df)) + 1 for df in self.document_frequency]


def counted_terms(terms: Column) -> Column:
    """array<struct<term, n>>: each distinct term of a document with its count, from runs in sorted order."""

    def runs(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))

        def lengths(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda s, k: F.struct(
                    F.get(ordered, s).alias("term"),
                    (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - s).alias("n"),
                ),
            )

        return let(starts, lengths)

    return let(F.sort_array(terms), lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)))


def with_words(df: DataFrame, stop_words: list[str], name: str = WORDS) -> DataFrame:
    """Adds the words of title and body that can be terms, in order, joined by blanks; null where the text is too short for topics.

    They hold all that the terms are made of, and less than half of what the counted terms take. Worked out a batch of texts
    at a time: lambdas of SQL functions run element by element. Of letters and digits outside ASCII only matters that a
    word with one is no term; Spark marks them, so that all ways agree on what a letter is.
    """

    def long_enough(text: Column) -> Column:
        return F.when(F.char_length(text) > MIN_CHARS, ascii_apart(F.lower(text), r"[\p{L}\p{N}&&[^\x00-\x7F]]", "_"))

    apart = bytes(i if chr(i).isalnum() and i < 128 or chr(i) == "_" else 32 for i in range(256))
    stops = pa.array(stop_words, pa.string())

    def wanted(words: pa.Array) -> pa.Array:
        return pc.and_not(pc.match_substring_regex(words, "^[a-z][a-z0-9]+$"), pc.is_in(words, value_set=stops))

    def some(text: pa.Array) -> pa.Array:
        row, code, words = coded(translated(text, apart), wanted)
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(text)))])
        kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(code)), mask=text.is_null())
        return pc.binary_join(kept, " ").cast(pa.string())

    return df.withColumn(name, _by_slices(some, pa.string(), "string")(let(strip(combined_text()), long_enough)))


def _by_slices(of_some: Callable[[pa.Array], pa.Array], arrow_type: pa.DataType, spark_type: str):
    return by_slices(of_some, arrow_type, spark_type, TEXTS_AT_ONCE)


def _beside(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and second of all neighbours in a row whose codes are not negative."""
    both = np.flatnonzero((row[1:] == row[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0))
    return row[both], code[both], code[both + 1]


def _counted_terms(words: Column) -> Column:
    """The same as :func:`counted_terms`, of words joined by blanks."""

    def some(text: pa.Array) -> pa.Array:
        row, code, words = coded(text)
        order = np.asarray(pc.sort_indices(words))
        words, rank = words.take(order), np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        code = rank[code]
        # a word is a pair without a second: a number for each term of each text, in the order of texts, then terms
        pair_row, first, second = _beside(row, code)
        first, second = np.concatenate([code, first]), np.concatenate([np.zeros_like(code), second + 1])
        base = len(words) + 1
        number, n = np.unique((np.concatenate([row, pair_row]) * base + first) * base + second, return_counts=True)
        (rest, second), ends = np.divmod(number, base), np.zeros(len(text) + 1, np.int64)
        row, first = np.divmod(rest, base)
        np.cumsum(np.bincount(row, minlength=len(text)), out=ends[1:])
        right = words.take(pa.array(second - 1, mask=second == 0))
        term = pc.binary_join_element_wise(words.take(pa.array(first)), right, " ", null_handling="skip")
        entries = pa.StructArray.from_arrays([term.cast(pa.string()), pa.array(n, pa.int32())], fields=list(COUNTED.value_type))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries, type=COUNTED, mask=text.is_null())

    return _by_slices(some, COUNTED, "array<struct<term:string,n:int>>")(words)


def with_terms(df: DataFrame, stop_words: list[str], name: str = TERMS) -> DataFrame:
    """Adds the counted terms of title and body, null where the text is too short for topics.

    The same as :func:`counted_terms` of :func:`terms_of`.
    """
    return with_words(df, stop_words, WORDS).withColumn(name, _counted_terms(F.col(WORDS))).drop(WORDS)


def worded(df: DataFrame, stop_words: list[str], *without: str) -> DataFrame:
    """The frame with its words and without some columns, written out: texts are worked through once for all that takes words."""
    return write_and_read(with_words(df, stop_words).drop(*without), "posts")


def term_table(df: DataFrame, stop_words: list[str], key: str = "id") -> DataFrame:
    """(key, words) of all posts with enough text, written out; words that ``df`` has already are used where they are."""
    enough = F.col(WORDS).isNotNull()
    if WORDS in df.columns:
        return df.select(key, WORDS).where(enough)
    return write_and_read(with_words(df.select(key, "title", "selftext"), stop_words).select(key, WORDS).where(enough), "terms")


def term_counts(table: DataFrame) -> DataFrame:
    """(term, corpus_count, document_frequency) of every term of a term table; one row per term and partition is shuffled."""
    return _counted(_terms(table))


def _terms(table: DataFrame) -> DataFrame:
    """(term, n, documents) of each term of each post."""
    return table.select(F.inline(_counted_terms(F.col(WORDS)))).withColumn("documents", F.lit(1))


def _counted(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.sum("n").alias("corpus_count"), F.sum("documents").alias("document_frequency"))


def _tallied(key: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, list[pa.Array]]:
    """The distinct keys, and how often and in how many rows each occurs."""
    number, n = np.unique(key * rows + row, return_counts=True)
    key = number // max(rows, 1)
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(n, starts) if len(starts) else n
    return key[starts], [pa.array(times, pa.int64()), pa.array(np.diff(starts, append=len(key)), pa.int64())]


def _words(table: DataFrame) -> DataFrame:
    """(term, n, documents) of the words of each batch of posts."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, code, words = coded(batch.column(0))
            code, tallies = _tallied(code, row, batch.num_rows)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(code)), *tallies], names=["term", "n", "documents"])

    return table.select(WORDS).mapInArrow(tally, f"term string, {TALLIED}")


def _pairs(table: DataFrame, words: list[str]) -> DataFrame:
    """(pair, n, documents) of the pairs of given words in each batch of posts; a pair is the number of its words' places."""
    known = pa.array(words, pa.string())

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, code, found = coded(batch.column(0))
            place = np.asarray(pc.fill_null(pc.index_in(found, value_set=known), -1), np.int64)
            row, first, second = _beside(row, place[code])
            pair, tallies = _tallied(first * len(known) + second, row, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), *tallies], names=["pair", "n", "documents"])

    return table.select(WORDS).mapInArrow(tally, f"pair bigint, {TALLIED}")


def _pair_term(pair: Column, words: list[str]) -> Column:
    """The term that the number of a pair stands for."""
    known = pa.array(words, pa.string())

    def name(pairs: pa.Array) -> pa.Array:
        first, second = np.divmod(np.asarray(pairs, np.int64), len(known))
        return pc.binary_join_element_wise(known.take(pa.array(first)), known.take(pa.array(second)), " ").cast(pa.string())

    name.__annotations__ = {"pairs": pa.Array, "return": pa.Array}
    return F.arrow_udf(name, "string")(pair)


def frequent_terms(table: DataFrame, tracked: int) -> tuple[DataFrame, float]:
    """(term) of at most ``tracked`` candidates, and a count that every term which is no candidate stays below.

    A frequent-items sketch of bounded size per partition, merged in a tree: sketches travel, terms don't. A sketch
    that tracks m items misses none that occurs more than 3.5 n / (m / 0.75) times among n.
    """
    occurrences = _terms(table).select(F.explode(F.expr("array_repeat(term, n)")).alias("term"))
    groups = max(1, occurrences.rdd.getNumPartitions() // SKETCHES_AT_ONCE)
    sketches = occurrences.groupBy((F.spark_partition_id() % groups).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate(term, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    while groups > 1:
        groups = groups // SKETCHES_AT_ONCE + (groups % SKETCHES_AT_ONCE > 0)
        sketches = sketches.groupBy((F.col("g") % groups).alias("g")).agg(
            F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n")
        )
    found = write_and_read(sketches.select("n", F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("items")), "frequent")
    total = found.agg(F.sum("n")).first()[0] or 0
    return found.select(F.inline("items")).select(F.col("item").alias("term")), 3.5 * 0.75 * total / tracked


def vocabulary_table(
    table: DataFrame, max_terms: int = 1000, min_df: int = 2, max_df: float = 0.8, tracked: int | None = None
) -> DataFrame:
    """(term, corpus_count, document_frequency) of the ``max_terms`` most frequent terms among those in
    enough and not too many documents.

    Where ``tracked`` says so, only candidates of a sketch are counted, exactly. Nothing was
    missed if enough of them occur more often than any other term can; otherwise all terms are counted.
    """
    documents = table.count()
    frequency = F.col("document_frequency")

    def best(counts: DataFrame) -> DataFrame:
        kept = counts.where((frequency >= min_df) & (frequency <= F.lit(max_df) * documents))
        return kept.orderBy(F.desc("corpus_count"), F.asc("term")).limit(max_terms)

    if tracked is None:
        return best(_possible_counts(table, best, max_terms, min_df))
    candidates, below = frequent_terms(table, tracked)
    counted = _counted(_terms(table).join(F.broadcast(candidates), "term", "left_semi"))
    found = write_and_read(best(counted), "vocabulary")
    last = found.agg(F.count(F.lit(1)).alias("n"), F.min("corpus_count").alias("least")).first()
    # fewer terms than wanted are all there are only if every term was tracked, which a bound below 1 says
    whole = below < 1 or (last["n"] == max_terms and last["least"] > below)
    return found.orderBy(F.desc("corpus_count"), F.asc("term")) if whole else best(term_counts(table))


def _possible_counts(table: DataFrame, best: Callable[[DataFrame], DataFrame], max_terms: int, min_df: int) -> DataFrame:
    """Counts of all words, and of all pairs that can be among the best.

    A pair occurs no more often than either of its words, and in no more documents. So once the best words are known,
    pairs with a word that is rarer than the last of them, or in too few documents, need not be counted.
    """
    words = write_and_read(_counted(_words(table)), "words")
    last = best(words).agg(F.count(F.lit(1)).alias("n"), F.min("corpus_count").alias("least")).first()
    least = last["least"] if last["n"] == max_terms else 0
    often = (F.col("corpus_count") >= least) & (F.col("document_frequency") >= min_df)
    paired = [r["term"] for r in words.where(often).select("term").limit(MOST_PAIRED + 1).collect()]
    if len(paired) > MOST_PAIRED:
        return words.unionByName(_counted(_terms(table).where(F.contains("term", F.lit(" ")))))
    pairs = _counted(_pairs(table, paired).withColumnRenamed("pair", "term")).where(often)
    return words.unionByName(pairs.withColumn("term", _pair_term(F.col("term"), paired)))


def fit_vocabulary(table: DataFrame, max_terms: int = 1000, min_df: int = 2, max_df: float = 0.8) -> Vocabulary:
    """The vocabulary of a term table as a model; at most ``max_terms`` rows reach the driver."""
    rows = sorted(vocabulary_table(table, max_terms, min_df, max_df).collect())
    return Vocabulary(
        [r["term"] for r in rows], [r["document_frequency"] for r in rows], [r["corpus_count"] for r in rows], table.count()
    )


def _vectors(vocabulary: Vocabulary) -> Callable[[pa.Array], pa.Array]:
    """The unit-length sparse vectors of posts, from their words or their counted terms: places of terms, rising, and weights."""
    idf, known = np.array(vocabulary.idf), pa.array(vocabulary.terms, pa.string())
    split = [term.split(" ") for term in vocabulary.terms]
    parts = sorted({word for words in split for word in words})
    at = {word: i for i, word in enumerate(parts)}
    alone = np.full(len(parts) + 1, -1)  # the last is for words that are in no term
    alone[[at[words[0]] for words in split if len(words) == 1]] = [place for place, words in enumerate(split) if len(words) == 1]
    together = sorted((at[words[0]] * len(parts) + at[words[1]], place) for place, words in enumerate(split) if len(words) == 2)
    pairs, pair_places = np.array(together, np.int64).reshape(-1, 2).T
    in_terms = pa.array(parts, pa.string())

    def of_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, code, words = coded(texts)
        part = np.asarray(pc.fill_null(pc.index_in(words, value_set=in_terms), -1), np.int64)[code]
        place = alone[part]
        pair_row, first, second = _beside(row, part)
        pair = first * len(parts) + second
        near = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
        found = np.flatnonzero(pairs[near] == pair) if len(pairs) else near[:0]
        row, place = np.concatenate([row[place >= 0], pair_row[found]]), np.concatenate([place[place >= 0], pair_places[near[found]]])
        number, n = np.unique(row * max(len(known), 1) + place, return_counts=True)
        return *np.divmod(number, max(len(known), 1)), n

    def of_terms(counted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.asarray(pc.fill_null(pc.list_value_length(counted), 0), np.int64)
        entries = counted.flatten()
        found = pc.index_in(entries.field("term"), value_set=known)
        kept = np.flatnonzero(np.asarray(found.is_valid()))
        row = np.repeat(np.arange(len(counted)), lengths)[kept]
        place, n = np.asarray(found.take(kept), np.int64), np.asarray(entries.field("n").take(kept))
        order = np.lexsort((place, row))
        return row[order], place[order], n[order]

    def weigh(posts: pa.Array) -> pa.Array:
        row, place, n = of_words(posts) if pa.types.is_string(posts.type) else of_terms(posts)
        weight = n * idf[place]
        # adds up in order, as places rise, so a row's norm doesn't depend on the rows beside it
        weight = weight / np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(posts)))[row]
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(posts)))]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, values) for values in (pa.array(place, pa.int32()), pa.array(weight, pa.float64()))]
        return pa.StructArray.from_arrays(lists, fields=list(VECTOR), mask=posts.is_null())

    return weigh


def tfidf_features(df: DataFrame, vocabulary: Vocabulary, terms: str = TERMS) -> DataFrame:
    """Adds ``tfidf``, the unit-length sparse vector of a post's terms: places of terms, rising, and weights. Nothing is shuffled.

    Terms are taken from a post's words where ``df`` has them, otherwise from counted terms.
    """
    vector = _by_slices(_vectors(vocabulary), VECTOR, "struct<indices:array<int>,values:array<double>>")
    return df.withColumn("tfidf", vector(WORDS if WORDS in df.columns else terms))


def tfidf_terms(features: DataFrame, vocabulary: Vocabulary, key: str = "id") -> DataFrame:
    """Long form: (key, term, tfidf)."""
    places, weights = sparse_parts("tfidf")
    spread = features.select(key, F.inline(F.arrays_zip(places.alias("place"), weights.alias("tfidf"))))
    names = F.array(*[F.lit(t) for t in vocabulary.terms])
    return spread.select(key, F.get(names, F.col("place")).alias("term"), "tfidf")


# ---- naming ---------------------------------------------------------------------------------
def topic_name(top_words: Column, categories: Mapping[str, list[str]] | None = None) -> Column:
    """The first category with a phrase of which any word occurs in the top five terms, else the top two."""
    categories = categories or fixed.TOPIC_CATEGORIES
    joined = F.lower(F.array_join(F.slice(top_words, 1, 5), " "))
    first, second = F.get(top_words, F.lit(0)), F.get(top_words, F.lit(1))
    name = F.coalesce(F.concat(first, F.lit("_"), second), first)
    for category, phrases in reversed(list(categories.items())):
        hits = F.lit(0)
        for phrase in phrases:
            found = F.lit(False)
            for word in phrase.split():
                found = found | F.contains(joined, F.lit(word))
            hits = hits + found.cast("int")
        name = F.when(hits > 0, F.concat(F.lit(f"{category}_"), hits.cast("string"))).otherwise(name)
    return name


@dataclass
class TopicModel:
    """A fitted vocabulary and factorisation."""

    vocabulary: Vocabulary
    nmf: NmfModel
    stop_words: list[str]

    def terms(self, df: DataFrame, n: int = 15) -> DataFrame:
        """(topic_id, place, term, weight) of each topic's heaviest terms. Its size is the model's."""
        rows = []
        for topic, weights in enumerate(self.nmf.components):
            ranked = sorted(zip(-weights, self.vocabulary.terms, strict=True))[:n]
            rows += [
                {"topic_id": topic, "place": place, "term": term, "weight": float(-weight)}
                for place, (weight, term) in enumerate(ranked, start=1)
            ]
        table = config_table(df.sparkSession, rows, "topic_id int, place int, term string, weight double")
        return table.withColumn("weight", half_even(F.col("weight"), 3))

    def names(self, df: DataFrame, categories: Mapping[str, list[str]] | None = None) -> DataFrame:
        """(topic_id, topic_name, top_words)."""
        words = self.terms(df, 10).groupBy("topic_id").agg(
            F.array_sort(F.collect_list(F.struct("place", "term"))).alias("_ranked")
        )
        return words.select(
            "topic_id", topic_name(F.col("_ranked.term"), categories).alias("topic_name"),
            F.array_join(F.col("_ranked.term"), ", ").alias("top_words"),
        )

    def assign(self, df: DataFrame, categories: Mapping[str, list[str]] | None = None) -> DataFrame:
        """Adds topic_id, topic_probability (a weight) and topic_name; posts stay where they are.

        Words that ``df`` has already are used, and dropped.
        """
        worded = df if WORDS in df.columns else with_words(df, self.stop_words)
        weighted = worded.withColumn("_w", self._topic_weights(df)(F.col(WORDS))).drop(WORDS)
        best = F.array_max("_w")
        clear = best > WEIGHT_FLOOR
        assigned = weighted.withColumns(
            {
                "topic_id": F.when(clear, (F.array_position("_w", best) - 1).cast("int")).otherwise(-1),
                "topic_probability": F.when(clear, half_even(best, 3)).otherwise(0.0),
            }
        ).drop("_w")
        named = assigned.join(F.broadcast(self.names(df, categories).drop("top_words")), "topic_id", "left")
        named = named.withColumn("topic_name", F.coalesce("topic_name", F.lit(fixed.UNCATEGORIZED)))
        return named.select(*[c for c in df.columns if c != WORDS], "topic_id", "topic_probability", "topic_name")

    def _topic_weights(self, df: DataFrame):
        """The weight of each topic, from words; vectors are made and used within a batch and don't travel."""
        vectors, of_lists = _vectors(self.vocabulary), self.nmf.of_lists(df)

        def weigh(words: pa.Array) -> pa.Array:
            found = vectors(words)
            return of_lists(found.field("indices"), found.field("values"))

        return _by_slices(weigh, pa.list_(pa.float64()), "array<double>")

    def weighted(self, posts: DataFrame) -> DataFrame:
        """Adds ``tfidf`` and ``_w``, the weight of each topic, to posts with words or counted terms."""
        featured = tfidf_features(posts, self.vocabulary)
        return featured.withColumn("_w", self.nmf.weights(*sparse_parts("tfidf"), posts))


def fit_on_terms(
    table: DataFrame, stop_words: list[str], n_topics: int = 8, min_posts: int = 5, max_terms: int = 1000, max_iter: int = 200
) -> TopicModel | None:
    """Fit on a term table; None when there are too few posts, or no terms."""
    vocabulary = fit_vocabulary(table, max_terms)
    if vocabulary.documents < min_posts or not vocabulary.terms:
        return None
    features = tfidf_features(table, vocabulary).select("tfidf")
    return TopicModel(vocabulary, fit_nmf(features, "tfidf", n_topics, max_iter, n_terms=len(vocabulary.terms)), stop_words)


def fit_topics(
    df: DataFrame, n_topics: int = 8, min_posts: int = 5, stop_words: list[str] | None = None,
    max_terms: int = 1000, max_iter: int = 200, key: str = "id",
) -> TopicModel | None:
    """Fit on all posts with enough text; None when there are too few, or no terms. Words that ``df`` has already are used."""
    words = default_stop_words() if stop_words is None else stop_words
    return fit_on_terms(term_table(df, words, key), words, n_topics, min_posts, max_terms, max_iter)


def model_topics(
    df: DataFrame, n_topics: int = 8, min_posts: int = 5, stop_words: list[str] | None = None,
    categories: Mapping[str, list[str]] | None = None, max_iter: int = 200,
) -> tuple[DataFrame, TopicModel | None]:
    """Posts with their topic, and the model; unchanged and None when there is too little to fit on.

    The posts are written out with their words, and read from there for all that follows.
    """
    words = default_stop_words() if stop_words is None else stop_words
    posts = worded(df, words)
    model = fit_on_terms(posts.select(WORDS).where(F.col(WORDS).isNotNull()), words, n_topics, min_posts, max_iter=max_iter)
    return (posts.drop(WORDS), None) if model is None else (model.assign(posts, categories), model)


def perform_topic_modeling(
    df: DataFrame, n_topics: int = 8, min_posts: int = 5, stop_words: list[str] | None = None,
    categories: Mapping[str, list[str]] | None = None, max_iter: int = 200,
) -> DataFrame:
    """Posts with their topic; unchanged when there is too little to fit on."""
    return model_topics(df, n_topics, min_posts, stop_words, categories, max_iter)[0]
