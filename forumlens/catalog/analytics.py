"""Sentiment, relevance, engagement, filters, topics, model scoring and the whole analysis."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.catalog.base import (
    AS_OF, LEXICON, LOCATIONS, OVERALL_SQL, PATTERNS, RELEVANCE_SQL, RULES, TARGETS, TERMS, TIERS, Views, clamp_sql,
    engagement_sql, half_even_sql, query, quoted, sentiment_sql,
)
from forumlens.functions.text import SPACE
from forumlens.operators import nmf, reports, scoring, topics
from forumlens.operators.engagement import calculate_engagement, comment_quality_flat
from forumlens.operators.filters import exclude_by_flat_comments, filter_by_thresholds, threshold_funnel, two_tier_filter
from forumlens.operators.ranking import final_sort
from forumlens.operators.relevance import filter_by_relevance, score_relevance, sort_by_relevance
from forumlens.operators.sentiment import (
    FIELDS, Lexicon, add_sentiment, content_sentiment, comments_sentiment, priority, score_by_join, sentiment, sentiment_tokens,
    title_sentiment,
)
from forumlens.plans.analysis import Settings, analyze
from forumlens.plans.collection import SearchSettings, collect_and_analyze
from forumlens.session import work_folder, write_and_read

# ---- sentiment -----------------------------------------------------------------------------
BODY_SENTIMENT = sentiment_sql("posts", "id", "selftext", "s")
SCORE_COLUMNS = "k as id, compound, pos, neu, neg, class, priority"


@query(
    "sentiment_tokens",
    f"select k as id, cast(i - 1 as int) as token_place, token, {half_even_sql('v', 6)} as valence from s_hits",
    BODY_SENTIMENT,
)
def tokens(v: Views) -> DataFrame:
    found = sentiment_tokens(v.posts(), "selftext", LEXICON, ["id"])
    return found.withColumn("valence", F.rint(F.col("valence") * 1e6) / 1e6)


#: Words of the given texts stand for those that have rules of their own.
RULE_WORDS = {
    " to ": " least ", " is ": " at ", " was ": " never ", " it ": " so ", " for ": " without ", " with ": " doubt ", " that ": " no ",
    " this ": " nor ", " and ": " kind of ", " in ": " no ", " on ": " without doubt ", " by ": " never so ",
}
PHRASES = Lexicon(
    {**LEXICON.valence, "no": -1.2, "kind": 2.4}, {**LEXICON.boosters, "stble the": 0.293, "of the": -0.293, "de la": 0.293}, ("thnt", "never", "without"),
    {"the ble": 2.5, "of ther": -1.8, "as innd": 1.2, "thed the": -2.4, "ble thedre": 0.7, "thre the": 1.9, "the the": 0.4, "least thed": -1.1, "least the thon": 2.2},
)
_RULED = "selftext"
for _word, _rule in RULE_WORDS.items():
    _RULED = f"replace({_RULED}, {quoted(_word)}, {quoted(_rule)})"
PHRASE_SENTIMENT = f"ruled as (select id, {_RULED} as body from posts)," + sentiment_sql("ruled", "id", "body", "s", PHRASES)


@query(
    "sentiment_phrases",
    f"select k as id, cast(i - 1 as int) as token_place, token, {half_even_sql('v', 6)} as valence from s_hits",
    PHRASE_SENTIMENT,
)
def phrase_tokens(v: Views) -> DataFrame:
    """Idioms, phrase boosters and the rules about "least", "kind of", "no", "never so" and "without doubt"."""
    ruled = v.posts().select("id", F.expr(_RULED).alias("body"))
    found = sentiment_tokens(ruled, "body", PHRASES, ["id"])
    return found.withColumn("valence", F.rint(F.col("valence") * 1e6) / 1e6)


@query("sentiment_phrase_score", f"select {SCORE_COLUMNS} from s", PHRASE_SENTIMENT)
def phrase_score(v: Views) -> DataFrame:
    scored = v.posts().select("id", sentiment(F.expr(_RULED), PHRASES).alias("s"))
    return scored.select("id", *[F.col("s")[f].alias(f) for f in FIELDS])


@query("sentiment_score", f"select {SCORE_COLUMNS} from s", BODY_SENTIMENT)
def sentiment_score(v: Views) -> DataFrame:
    scored = v.posts().select("id", sentiment(F.col("selftext"), LEXICON).alias("s"))
    return scored.select("id", *[F.col("s")[f].alias(f) for f in FIELDS])


@query("sentiment_score_joined", f"select {SCORE_COLUMNS} from s", BODY_SENTIMENT)
def sentiment_score_joined(v: Views) -> DataFrame:
    from forumlens.functions.lookup import config_table

    rows = [{"token": t, "valence": x} for t, x in LEXICON.valence.items()]
    return score_by_join(v.posts(), "selftext", config_table(v.spark, rows, "token string, valence double"), LEXICON)


@query("sentiment_priority", f"""select id, {half_even_sql('''case when c > 0 then least(100e0, 50 + c * 50 + p * 25)
 else greatest(10e0, 50 + c * 30) end''', 2)} as priority from (select id, upvote_ratio * 2 - 1.5e0 as c, upvote_ratio as p from posts)""")
def sentiment_priority(v: Views) -> DataFrame:
    compound = F.col("upvote_ratio") * 2 - 1.5
    return v.posts().select("id", priority(compound, F.col("upvote_ratio")).alias("priority"))


@query(
    "title_sentiment",
    "select k as id, compound as title_sentiment_compound, pos as title_sentiment_pos, neu as title_sentiment_neu,"
    " neg as title_sentiment_neg, class as title_sentiment_class, priority as title_sentiment_priority from s",
    sentiment_sql("posts", "id", "title", "s"),
)
def titles(v: Views) -> DataFrame:
    return title_sentiment(v.posts().select("id", "title"), LEXICON).drop("title")


@query("content_sentiment", "select id, content_sentiment_class, content_sentiment_priority from overall", OVERALL_SQL)
def contents(v: Views) -> DataFrame:
    scored = content_sentiment(title_sentiment(v.posts(), LEXICON), LEXICON)
    return scored.select("id", "content_sentiment_class", "content_sentiment_priority")


@query("comments_sentiment", f"select id, {half_even_sql('comments_sentiment_avg', 6)} as comments_sentiment_avg from overall", OVERALL_SQL)
def comment_moods(v: Views) -> DataFrame:
    scored = comments_sentiment(v.nested(), LEXICON)
    return scored.select("id", (F.rint(F.col("comments_sentiment_avg") * 1e6) / 1e6).alias("comments_sentiment_avg"))


@query("overall_sentiment", "select id, overall_sentiment_score, overall_sentiment_class from overall", OVERALL_SQL)
def overall(v: Views) -> DataFrame:
    return add_sentiment(v.nested(), LEXICON).select("id", "overall_sentiment_score", "overall_sentiment_class")


@query("sentiment_distribution", "select overall_sentiment_class, count(*) as posts from overall group by 1", OVERALL_SQL)
def sentiment_distribution(v: Views) -> DataFrame:
    return reports.sentiment_distribution(add_sentiment(v.nested(), LEXICON))


# ---- relevance and engagement --------------------------------------------------------------
@query("relevance_score", "select id, relevance_score from relevance", RELEVANCE_SQL)
def relevance_score(v: Views) -> DataFrame:
    return score_relevance(v.nested(), RULES).select("id", "relevance_score")


@query("relevance_filter", "select id, title, relevance_score from relevance where relevance_score >= 50", RELEVANCE_SQL)
def relevance_filter(v: Views) -> DataFrame:
    return sort_by_relevance(filter_by_relevance(v.nested(), RULES)).select("id", "title", "relevance_score")


@query(
    "relevance_summary",
    f"""select count(*) as original_posts, count(*) filter (relevance_score >= 50) as relevant_posts,
    count(*) filter (relevance_score < 50) as filtered_out,
    {half_even_sql('count(*) filter (relevance_score >= 50) * 100e0 / count(*)', 1)} as relevant_pct,
    {half_even_sql('avg(relevance_score) filter (relevance_score >= 50)', 1)} as avg_relevance,
    max(relevance_score) filter (relevance_score >= 50) as max_relevance from relevance""",
    RELEVANCE_SQL,
)
def relevance_summary(v: Views) -> DataFrame:
    return reports.relevance_summary(score_relevance(v.nested(), RULES), fixed.RELEVANCE_CUT)


GATED_SQL = (
    RELEVANCE_SQL + ", gated as (select * from relevance where relevance_score >= 50)," + engagement_sql("gated", fixed.PRESET_WEIGHTS)
)
PARTS = ["score_normalized", "upvote_ratio_normalized", "comments_normalized", "comment_quality_score", "recency_score", "engagement_score"]


def engaged(v: Views) -> DataFrame:
    """Written out between gate and engagement, as the analysis does: the maxima need a second pass."""
    gated = write_and_read(filter_by_relevance(v.nested(), RULES).drop("selftext"), "gated")
    return calculate_engagement(gated, fixed.PRESET_WEIGHTS)


@query("engagement_score", f"select id, relevance_score, {', '.join(PARTS)} from engaged", GATED_SQL)
def engagement_score(v: Views) -> DataFrame:
    return engaged(v).select("id", "relevance_score", *PARTS)


@query(
    "comment_quality",
    f"select post_id, count(*) as comments_collected, avg(score) as avg_comment_score, max(score) as max_comment_score,"
    f" {clamp_sql('(avg(score) + max(score)) * 5')} as comment_quality_score from all_comments group by post_id",
)
def comment_quality(v: Views) -> DataFrame:
    return comment_quality_flat(v.valid_comments())


ALL_ENGAGED_SQL = RELEVANCE_SQL + "," + engagement_sql("relevance", fixed.DEFAULT_WEIGHTS)
PRESET_SQL = "engagement_score >= 30 and score >= 3 and num_comments >= 1 and upvote_ratio >= 0.6e0 and days_ago <= 14"
BRIEF = "id, subreddit, score, num_comments, relevance_score, engagement_score"


def all_engaged(v: Views) -> DataFrame:
    """Relevance is written once; the maxima then read two columns of it."""
    return calculate_engagement(write_and_read(score_relevance(v.nested(), RULES), "scored"))


@query("filter_thresholds", f"select {BRIEF} from engaged where {PRESET_SQL}", ALL_ENGAGED_SQL)
def filter_thresholds(v: Views) -> DataFrame:
    return filter_by_thresholds(all_engaged(v), fixed.PRESET_THRESHOLDS).select(*BRIEF.split(", "))


@query("two_tier_filter", f"select {BRIEF} from engaged where relevance_score >= 50 or ({PRESET_SQL})", ALL_ENGAGED_SQL)
def two_tier(v: Views) -> DataFrame:
    return two_tier_filter(all_engaged(v), fixed.PRESET_THRESHOLDS).select(*BRIEF.split(", "))


EXCLUDED = ["Rewh", "thhe", "orre"]
EXCLUDED_SQL = (
    "(select post_id from ranked_comments where " + " or ".join(f"contains(lower(body), {quoted(k.lower())})" for k in EXCLUDED) + ")"
)


@query("exclude_keywords", f"select id, subreddit from posts where id not in {EXCLUDED_SQL}")
def exclude_keywords(v: Views) -> DataFrame:
    return filter_by_thresholds(v.nested(), {"exclude_keywords": EXCLUDED}).select("id", "subreddit")


@query("exclude_keywords_flat", f"select id, subreddit from posts where id not in {EXCLUDED_SQL.replace('ranked_comments', 'all_comments')}")
def exclude_keywords_flat(v: Views) -> DataFrame:
    return exclude_by_flat_comments(v.posts(), v.valid_comments(), EXCLUDED).select("id", "subreddit")


FUNNEL = {**fixed.PRESET_THRESHOLDS, "max_hours_ago": 240, "subreddits": ["src1", "src2", "src3"], "exclude_keywords": EXCLUDED}
_STEPS = [
    ("start", "true"), ("min_engagement_score", "engagement_score >= 30"), ("min_score", "score >= 3"),
    ("min_comments", "num_comments >= 1"), ("min_upvote_ratio", "upvote_ratio >= 0.6e0"), ("max_hours_ago", "hours_ago <= 240"),
    ("max_days_ago", "days_ago <= 14"), ("subreddits", "subreddit in ('src1', 'src2', 'src3')"),
    ("exclude_keywords", f"id not in {EXCLUDED_SQL}"),
]


@query(
    "threshold_funnel",
    " union all ".join(
        f"select {i} as step_ord, '{name}' as step, count(*) as remaining from engaged where "
        + " and ".join(f"({p})" for _, p in _STEPS[: i + 1])
        for i, (name, _) in enumerate(_STEPS)
    ),
    ALL_ENGAGED_SQL,
)
def funnel(v: Views) -> DataFrame:
    return threshold_funnel(all_engaged(v), FUNNEL)


WHOLE_SQL = (
    OVERALL_SQL + "," + RELEVANCE_SQL.replace("from posts p left join first_comments", "from overall p left join first_comments")
    + ", gated as (select * from relevance where relevance_score >= 50)," + engagement_sql("gated", fixed.PRESET_WEIGHTS)
)


def judged(v: Views) -> DataFrame:
    scored = write_and_read(add_sentiment(filter_by_relevance(v.nested(), RULES), LEXICON), "judged")
    return two_tier_filter(calculate_engagement(scored, fixed.PRESET_WEIGHTS), fixed.PRESET_THRESHOLDS)


@query("final_sort", "select id, relevance_score, overall_sentiment_class, engagement_score, score, hours_ago from engaged", WHOLE_SQL)
def sorted_posts(v: Views) -> DataFrame:
    ordered = final_sort(judged(v))
    return ordered.select("id", "relevance_score", "overall_sentiment_class", "engagement_score", "score", "hours_ago")


@query(
    "ranked_relevant_posts",
    f"""select id, title, subreddit, relevance_score, engagement_score, score, hours_ago from engaged
    order by relevance_score desc, engagement_score desc, score desc, hours_ago, id limit 20""",
    GATED_SQL,
)
def ranked_relevant_posts(v: Views) -> DataFrame:
    """The flagship: relevance gate, engagement, final order, first twenty."""
    best = final_sort(engaged(v)).limit(20)
    return best.select("id", "title", "subreddit", "relevance_score", "engagement_score", "score", "hours_ago")


# ---- topics --------------------------------------------------------------------------------
STOP_WORDS = ["the", "and", "of", "is", "that", "in", "la", "de", "und", "der", *fixed.EXTRA_STOP_WORDS]
_EDGE = rf"^[{SPACE}]+|[{SPACE}]+$"
TERMS_SQL = f"""
docs as (
 select * from (select id, regexp_replace(coalesce(title, '') || ' ' || coalesce(selftext, ''), '{_EDGE}', '', 'g') as text from posts)
 where length(text) > 20),
words as (
 select id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
  lambda w: regexp_full_match(w, '[a-z][a-z0-9]+') and w not in ({', '.join(quoted(w) for w in STOP_WORDS)})) as l from docs),
terms as (
 select id, unnest(l) as term from words union all
 select id, unnest(list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])) from words where len(l) > 1),
term_stats as (select term, count(*) as corpus_count, count(distinct id) as document_frequency from terms group by term),
vocab as (
 select *, ln((1 + n) / (1 + document_frequency)) + 1 as idf from term_stats cross join (select count(*) as n from docs)
 where document_frequency >= 2 and document_frequency <= 0.8e0 * n order by corpus_count desc, term limit 1000),
weights as (
 select id, term, count(*) * any_value(idf) as w from terms join vocab using (term) group by id, term),
tfidf as (select id, term, w / sqrt(sum(w * w) over (partition by id)) as tfidf from weights)
"""


@query(
    "topic_documents",
    f"""select * from (select id, regexp_replace(coalesce(title, '') || ' ' || coalesce(selftext, ''), '{_EDGE}', '', 'g') as text from posts)
    where length(text) > 20""",
)
def topic_documents(v: Views) -> DataFrame:
    return topics.topic_documents(v.posts())


@query("tfidf_vocab", "select term, corpus_count, document_frequency from vocab", TERMS_SQL)
def tfidf_vocab(v: Views) -> DataFrame:
    return topics.vocabulary_table(topics.term_table(v.posts(), STOP_WORDS))


@query("tfidf_vocab_sketched", "select term, corpus_count, document_frequency from (select * from vocab order by corpus_count desc, term limit 5)", TERMS_SQL)
def tfidf_vocab_sketched(v: Views) -> DataFrame:
    """A short vocabulary from few tracked terms, as it is where a corpus has far more terms than a sketch tracks."""
    return topics.vocabulary_table(topics.term_table(v.posts(), STOP_WORDS), 5, tracked=2_000)


@query("tfidf_terms", f"select id, term, {half_even_sql('tfidf', 6)} as tfidf from tfidf", TERMS_SQL)
def tfidf_terms(v: Views) -> DataFrame:
    table = topics.term_table(v.posts(), STOP_WORDS)
    vocabulary = topics.fit_vocabulary(table)
    long = topics.tfidf_terms(topics.tfidf_features(table, vocabulary), vocabulary)
    return long.withColumn("tfidf", F.rint(F.col("tfidf") * 1e6) / 1e6)


def worded_posts(v: Views, stop_words: list[str]) -> DataFrame:
    """Posts with their words in place of title and body; fitted on and assigned from there."""
    return topics.worded(v.posts(), stop_words, "title", "selftext")


def topic_model(posts: DataFrame) -> topics.TopicModel:
    return topics.fit_topics(posts)


@query("topic_model")
def topic_weights(v: Views) -> DataFrame:
    """W of every post with enough text."""
    posts = worded_posts(v, topics.default_stop_words())
    return topic_model(posts).weighted(posts.where(F.col(topics.WORDS).isNotNull())).select("id", F.posexplode("_w").alias("topic_id", "weight"))


@query("topic_assign")
def topic_assign(v: Views) -> DataFrame:
    posts = worded_posts(v, topics.default_stop_words())
    assigned = topic_model(posts).assign(posts)
    return assigned.select("id", "topic_id", "topic_probability", "topic_name")


@query("topic_distribution")
def topic_distribution(v: Views) -> DataFrame:
    posts = worded_posts(v, topics.default_stop_words())
    return reports.topic_distribution(topic_model(posts).assign(posts))


@query("topic_terms")
def topic_terms(v: Views) -> DataFrame:
    return topic_model(v.posts()).terms(v.posts())


@query("topic_names")
def topic_names(v: Views) -> DataFrame:
    return topic_model(v.posts()).names(v.posts())


# A model with given factors, so that everything after the fit has SQL: two topics, W from two sweeps.
NO_CATEGORY = {"none": ["no such word"]}


def given_model(posts: DataFrame) -> topics.TopicModel:
    vocabulary = topics.fit_vocabulary(topics.term_table(posts, STOP_WORDS))
    place = np.arange(len(vocabulary.terms))
    h = np.stack([place % 7 / 7, place * 3 % 5 / 5])
    start = nmf.Start(h.T, np.ones(2), np.ones(2), np.ones(2))
    return topics.TopicModel(vocabulary, nmf.NmfModel(h, start, [h, h], []), STOP_WORDS)


def _sweep(before: str, after: str) -> str:
    first = "greatest(w0 - (w0 * g00 + w1 * g01 - c0) / g00, 0e0)"
    return (
        f"{after}a as (select * exclude (w0), {first} as w0 from {before}),"
        f" {after} as (select * exclude (w1), greatest(w1 - (w0 * g01 + w1 * g11 - c1) / g11, 0e0) as w1 from {after}a)"
    )


GIVEN_SQL = f"""{TERMS_SQL},
factors as (select term, ((row_number() over (order by term) - 1) % 7) / 7e0 as h0, ((row_number() over (order by term) - 1) * 3 % 5) / 5e0 as h1 from vocab),
gram as (select sum(h0 * h0) as g00, sum(h0 * h1) as g01, sum(h1 * h1) as g11 from factors),
crossed as (select id, sum(tfidf * h0) as c0, sum(tfidf * h1) as c1 from tfidf join factors using (term) group by id),
begun as (select *, case when c0 < 1e-6 then 0e0 else c0 end as w0, case when c1 < 1e-6 then 0e0 else c1 end as w1 from crossed cross join gram),
{_sweep('begun', 'once')}, {_sweep('once', 'twice')},
weighed as (select id, 0 as topic, w0 as weight from twice union all select id, 1, w1 from twice),
heaviest as (
 select t.topic, t.term, t.weight, row_number() over (partition by t.topic order by t.weight desc, t.term) as place
 from (select 0 as topic, term, h0 as weight from factors union all select 1, term, h1 from factors) t),
named as (select a.topic, a.term || '_' || b.term as name from heaviest a join heaviest b using (topic) where a.place = 1 and b.place = 2),
assigned as (
 select p.id, coalesce(case when greatest(w0, w1) > 0.1e0 then case when w0 >= w1 then 0 else 1 end end, -1) as topic_id,
  coalesce(case when greatest(w0, w1) > 0.1e0 then {half_even_sql('greatest(w0, w1)', 3)} end, 0e0) as topic_probability
 from posts p left join twice t on p.id = t.id),
topical as (select a.*, coalesce(n.name, 'uncategorized') as topic_name from assigned a left join named n on a.topic_id = n.topic)
"""


@query("topic_weights_given", f"select id, topic as topic_id, {half_even_sql('weight', 6)} as weight from weighed", GIVEN_SQL)
def topic_weights_given(v: Views) -> DataFrame:
    """W of two sweeps from given factors."""
    posts = worded_posts(v, STOP_WORDS)
    long = given_model(posts).weighted(posts.where(F.col(topics.WORDS).isNotNull())).where(F.size("tfidf.indices") > 0).select("id", F.posexplode("_w").alias("topic_id", "weight"))
    return long.withColumn("weight", F.rint(F.col("weight") * 1e6) / 1e6)


@query("topic_assign_given", "select id, topic_id, topic_probability, topic_name from topical", GIVEN_SQL)
def topic_assign_given(v: Views) -> DataFrame:
    posts = worded_posts(v, STOP_WORDS)
    assigned = given_model(posts).assign(posts, NO_CATEGORY)
    return assigned.select("id", "topic_id", "topic_probability", "topic_name")


@query("topic_distribution_given", "select topic_name, count(*) as posts from topical group by 1", GIVEN_SQL)
def topic_distribution_given(v: Views) -> DataFrame:
    posts = worded_posts(v, STOP_WORDS)
    return reports.topic_distribution(given_model(posts).assign(posts, NO_CATEGORY))


@query(
    "topic_terms_given",
    f"select topic as topic_id, cast(place as int) as place, term, {half_even_sql('weight', 3)} as weight from heaviest where place <= 15",
    GIVEN_SQL,
)
def topic_terms_given(v: Views) -> DataFrame:
    return given_model(v.posts()).terms(v.posts())


@query(
    "topic_names_given",
    "select topic as topic_id, name as topic_name, string_agg(term, ', ' order by place) as top_words from heaviest join named using (topic)"
    " where place <= 10 group by 1, 2",
    GIVEN_SQL,
)
def topic_names_given(v: Views) -> DataFrame:
    return given_model(v.posts()).names(v.posts(), NO_CATEGORY)


# ---- model scoring -------------------------------------------------------------------------
CUT_NAMES = f"""
 rolled as (
 select post_id, string_agg(trim(regexp_replace(replace(replace(regexp_replace(body, '{_EDGE}', '', 'g'), '\\n', ' '), '\\r', ' '),
   '[{SPACE}]+', ' ', 'g')), ' | ' order by comment_rank) as t
 from ranked_comments where length(regexp_replace(body, '{_EDGE}', '', 'g')) > 5 group by post_id),
rollups as (select post_id, case when length(t) > 2000 then left(t, 2000) || '... [truncated]' else t end as comment_text from rolled)
"""
_PROMPT = scoring.Prompt()
PROMPT_SQL = (
    f"{quoted(_PROMPT.before)} || 'Title: ' || left(coalesce(title, ''), 400) || chr(10) || 'Content: ' ||"
    " case when coalesce(selftext, '') = '' then 'No content' else left(selftext, 800) end || chr(10) || 'Comments: ' ||"
    f" coalesce(comment_text, 'No comments available') || {quoted(_PROMPT.after)}"
)


def stand_in(prompts: list[str]) -> list[str]:
    """A stand-in for a model: a reply that depends on the whole prompt, and none for some of them."""
    return ["no idea" if len(p) % 9 == 0 else f"Score: {len(p) % 130}, roughly" for p in prompts]


REPLY_SQL = """case when length(prompt) % 9 = 0 then 50e0 else cast(least(length(prompt) % 130, 100) as double) end"""
PROMPTED_SQL = CUT_NAMES + f", prompted as (select id, {PROMPT_SQL} as prompt from posts p left join rollups r on p.id = r.post_id)"


@query("comment_rollup", "select p.id, coalesce(comment_text, '') as comment_text from posts p left join rollups r on p.id = r.post_id", CUT_NAMES)
def comment_rollup(v: Views) -> DataFrame:
    return v.nested().select("id", scoring.comment_rollup().alias("comment_text"))


@query("comment_rollup_flat", "select * from rollups", CUT_NAMES.replace("ranked_comments", "all_comments"))
def comment_rollup_flat(v: Views) -> DataFrame:
    return scoring.comment_rollup_flat(v.valid_comments().withColumn("by_score", -F.col("score")), ["by_score", "comment_id"])


@query("scoring_prompt", "select * from prompted", PROMPTED_SQL)
def scoring_prompt(v: Views) -> DataFrame:
    return v.nested().select("id", scoring.scoring_prompt(scoring.comment_rollup()).alias("prompt"))


@query(
    "parse_model_score",
    """select id, coalesce(least(cast(list_filter(regexp_split_to_array(title || ' ' || score || ' points', '[^\\p{L}\\p{N}_]+'),
    lambda w: regexp_full_match(w, '[0-9]{1,3}'))[1] as double), 100e0), 50e0) as parsed from posts""",
)
def parse_model_score(v: Views) -> DataFrame:
    reply = F.concat("title", F.lit(" "), F.col("score").cast("string"), F.lit(" points"))
    return v.posts().select("id", scoring.parse_score(reply).alias("parsed"))


@query("model_score", f"select id, {REPLY_SQL} as llm_relevance_score, 'scored' as score_status from prompted", PROMPTED_SQL)
def model_score(v: Views) -> DataFrame:
    return scoring.score_posts(v.nested(), stand_in).select("id", "llm_relevance_score", "score_status")


CACHED_SQL = "cast(id as bigint) % 4 = 0"


def cached_scores(v: Views) -> DataFrame:
    """Scores of an earlier run: a quarter of the posts, some of them failures."""
    return v.posts().where(CACHED_SQL).selectExpr(
        "id", "cast(upvote_ratio * 100 as double) as llm_relevance_score",
        "case when cast(id as bigint) % 12 = 0 then 'failed' else 'scored' end as score_status",
    )


@query(
    "resume_scoring",
    f"select id, subreddit from posts where not ({CACHED_SQL} and cast(id as bigint) % 12 <> 0)",
)
def resume_scoring(v: Views) -> DataFrame:
    return scoring.not_yet_scored(v.posts(), cached_scores(v)).select("id", "subreddit")


@query(
    "score_table",
    f"select p.id, case when {CACHED_SQL} and cast(p.id as bigint) % 12 <> 0 then upvote_ratio * 100 else {REPLY_SQL} end as"
    " llm_relevance_score, 'scored' as score_status from posts p join prompted using (id)",
    PROMPTED_SQL,
)
def score_table(v: Views) -> DataFrame:
    path = work_folder(v.spark, "scores")
    cached_scores(v).write.parquet(path)
    return scoring.score_table(v.nested(), stand_in, path).select("id", "llm_relevance_score", "score_status")


@query(
    "score_progress",
    f"""select count(*) as scored, count(*) filter (not c) as new, count(*) filter (c) as cached, cast(0 as bigint) as failed,
     {half_even_sql('avg(x)', 6)} as average from (select {CACHED_SQL} and cast(p.id as bigint) % 12 <> 0 as c,
      case when {CACHED_SQL} and cast(p.id as bigint) % 12 <> 0 then upvote_ratio * 100 else {REPLY_SQL} end as x from posts p join prompted using (id))""",
    PROMPTED_SQL,
)
def score_progress(v: Views) -> DataFrame:
    """What a scoring run reports after its last bucket, observed while the buckets are written."""
    path, told = work_folder(v.spark, "scores"), []
    cached_scores(v).write.parquet(path)
    scoring.score_table(v.nested(), stand_in, path, buckets=4, report=told.append)
    last = told[-1]
    row = (last.scored, last.new, last.cached, last.failed, round(last.average, 6))
    return v.spark.createDataFrame([row], "scored bigint, new bigint, cached bigint, failed bigint, average double")


@query(
    "rank_by_model_score",
    f"""select id, case when cast(id as bigint) % 5 = 0 then 50e0 else {half_even_sql('upvote_ratio * 100', 2)} end as llm_relevance_score
    from posts order by 2 desc, 1""",
)
def rank_by_model_score(v: Views) -> DataFrame:
    scored = v.posts().selectExpr("id", "case when cast(id as bigint) % 5 <> 0 then rint(upvote_ratio * 10000) / 100 end as llm_relevance_score")
    return scoring.rank_by_model_score(scored)


@query(
    "score_buckets",
    f"""select count(*) as total, {half_even_sql('avg(x)', 1)} as avg_score, count(*) filter (x >= 70) as high,
    count(*) filter (x >= 50 and x < 70) as medium, count(*) filter (x < 50) as low,
    {half_even_sql('count(*) filter (x >= 70) * 100e0 / count(*)', 1)} as high_pct,
    {half_even_sql('count(*) filter (x >= 50 and x < 70) * 100e0 / count(*)', 1)} as medium_pct,
    {half_even_sql('count(*) filter (x < 50) * 100e0 / count(*)', 1)} as low_pct
    from (select {REPLY_SQL} as x from prompted)""",
    PROMPTED_SQL,
)
def score_buckets(v: Views) -> DataFrame:
    return reports.score_buckets(scoring.score_posts(v.nested(), stand_in))


# ---- whole analyses ------------------------------------------------------------------------
SETTINGS = Settings(fixed.PRESET_WEIGHTS, fixed.PRESET_THRESHOLDS, RULES, LEXICON)
ANALYSED = [
    "id", "overall_sentiment_score", "overall_sentiment_class", "topic_id", "topic_probability", "topic_name",
    "relevance_score", "engagement_score", "score", "hours_ago",
]


@query("analyze_one")
def analyze_one(v: Views) -> DataFrame:
    return analyze(v.nested(), SETTINGS).posts.select(*ANALYSED)


@query("analyze_combined")
def analyze_combined(v: Views) -> DataFrame:
    from forumlens.catalog.collecting import united
    from forumlens.operators.ranking import dedupe_posts

    posts = dedupe_posts(united(v), ["file_order", "row_order"])
    return analyze(posts, SETTINGS).posts.select(*ANALYSED)


@query("collect_and_analyze")
def collected_and_analyzed(v: Views) -> DataFrame:
    plan = SearchSettings(TARGETS, TERMS, LOCATIONS, 30)
    return collect_and_analyze(v.posts(), v.comments(), AS_OF, "both", TIERS, plan, SETTINGS).posts.select(*ANALYSED)


@query("scored_unfiltered", f"select id, relevance_score, engagement_score from engaged", GATED_SQL)
def scored_unfiltered(v: Views) -> DataFrame:
    """All scored posts as the optional second output holds them, written and read back."""
    path = work_folder(v.spark, "unfiltered")
    engaged(v).write.parquet(path)
    return v.spark.read.parquet(path).select("id", "relevance_score", "engagement_score")

