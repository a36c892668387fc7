"""Registration, and the posts, comments and user comments derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.text import HANDLE_PATTERN, SPACES_PATTERN, SYMBOL_PATTERN, URL_PATTERN
from forumlens.operators.collect import attach_comments, top_comments, valid_comments
from forumlens.operators.relevance import RelevanceRules
from forumlens.operators.sentiment import Lexicon
from forumlens.session import spread_small_input

AS_OF = 1706659200
SOURCE, DESTINATION, IMPLEMENTATION = ["rewh", "license", "thatin"], ["thon", "orre", "ononst"], ["thre", "thor", "hehely"]
PATTERNS = ["than.*the", "er.*tion"]
RULES = RelevanceRules(SOURCE, DESTINATION, IMPLEMENTATION, PATTERNS, [])
LEXICON = Lexicon(
    {
        "than": 1.5, "thon": -1.8, "tion": 2.0, "thre": -2.2, "thor": 0.8, "ble": 1.1, "ther": -0.6, "thin": -1.2,
        "thhe": 2.7, "thed": -0.9,
    },
    {"thth": 0.293},
    ("thnt",),
)
USERS = ["user_1", "user_2", "user_none"]
TERMS = ["than tion", "thre", "thor ble"]
LOCATIONS = ["src0", "src3"]
TARGETS = ["rewh", "ononst", "hehely", "thatin", "Thhe"]


def _tier(low: int, high: int, limit: int) -> dict:
    return {
        "subreddits": [f"src{i}" for i in range(low, high + 1)], "posts_per_sub": limit, "time_filter": "week",
        "description": f"limit {limit}",
    }


TIERS = {
    "high": _tier(0, 3, 15), "medium": _tier(4, 9, 10), "low": _tier(10, 15, 5), "very_low": _tier(16, 18, 3),
    "empty": {"subreddits": ["src_none"], "posts_per_sub": 2, "time_filter": "week", "description": "limit 2"},
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# ---- views ---------------------------------------------------------------------------------
POST_COLUMNS = [
    "cast(d.doc_id as string) as id",
    "split_part(d.text, chr(10), 1) as title",
    "case when d.doc_id % 17 = 0 then null else d.text end as selftext",
    "case when d.doc_id % 29 = 0 then '[deleted]' else concat('u', cast(d.doc_id % 37 as string)) end as author",
    "(d.doc_id * 37) % 500 - 20 as score",
    "((d.doc_id * 13) % 51 + 50) / 100e0 as upvote_ratio",
    "(d.doc_id * 7) % 60 as num_comments",
    "1706659200 - ((d.doc_id * 5) % 720) * 3600 as created_utc",
    "cast((d.doc_id * 5) % 720 as double) as hours_ago",
    "((d.doc_id * 5) % 720) / 24e0 as days_ago",
    "d.source as subreddit",
    "d.lang as flair_text",
]
COMMENT_COLUMNS = [
    "cast(conv_id as string) as post_id",
    "concat(cast(conv_id as string), '_', cast(turn as string)) as comment_id",
    "case when turn = 0 then concat('t3_', cast(conv_id as string)) "
    "else concat('t1_', cast(conv_id as string), '_', cast(turn - 1 as string)) end as parent_id",
    "role as author",
    "case when (conv_id + turn) % 11 = 0 then '[deleted]' else text end as body",
    "(conv_id * 31 + turn * 17) % 40 - 5 as score",
    "1706659200 - ((conv_id * 11 + turn) % 600) * 3600 as created_utc",
    "role = 'user' as is_submitter",
    "turn as depth",
]


def _user_columns(epoch: str) -> list[str]:
    return [
        "cast(event_id as string) as comment_id",
        "concat('user_', cast(user_id as string)) as author",
        "case when event_id % 23 = 0 then '[removed]' else props end as body",
        "cast(floor(value) as bigint) as score",
        f"{epoch} as created_utc",
        "event_type as subreddit",
        f"cast(floor((1706659200 - {epoch}) / 86400e0) as bigint) as days_ago",
    ]


class Views:
    """The given tables in the shapes the operators take."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return spread_small_input(self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    def posts(self) -> DataFrame:
        return self.table("documents").alias("d").selectExpr(*POST_COLUMNS)

    def posts_with_flags(self) -> DataFrame:
        documents, labels = self.table("documents").alias("d"), self.table("labels").alias("l")
        joined = documents.join(labels, F.col("d.doc_id") == F.col("l.doc_id"), "left")
        return joined.selectExpr(*POST_COLUMNS, "coalesce(l.toxic = 1, false) as over_18")

    def comments(self) -> DataFrame:
        return self.table("conversations").selectExpr(*COMMENT_COLUMNS)

    def user_comments(self) -> DataFrame:
        return self.table("events").selectExpr(*_user_columns("unix_seconds(cast(ts as timestamp))"))

    def ranked_comments(self) -> DataFrame:
        return top_comments(self.comments(), 200)

    def valid_comments(self) -> DataFrame:
        """All comments that count, however many a post has."""
        return valid_comments(self.comments())

    def nested(self) -> DataFrame:
        return attach_comments(self.posts(), self.ranked_comments())


VIEW_SQL = f"""
posts as (select {', '.join(POST_COLUMNS)}, coalesce(l.toxic = 1, false) as over_18
 from documents d left join labels l on d.doc_id = l.doc_id),
comments as (select {', '.join(COMMENT_COLUMNS)} from conversations),
user_comments as (select {', '.join(_user_columns("cast(floor(epoch(ts)) as bigint)"))} from events),
all_comments as (
 select *, row_number() over (partition by post_id order by score desc, comment_id) as comment_rank
 from comments where body <> '[deleted]' and score is not null),
ranked_comments as (select * from all_comments where comment_rank <= 200)
"""


# ---- SQL fragments -------------------------------------------------------------------------
TEXT = "lower(coalesce(title, '') || ' ' || coalesce(selftext, ''))"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def half_even_sql(value: str, digits: int) -> str:
    scale = f"{10**digits}e0"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def clamp_sql(value: str) -> str:
    return f"(case when ({value}) < 0 then 0e0 when ({value}) > 100 then 100e0 else cast({value} as double) end)"


def count_sql(text: str, keywords: list[str]) -> str:
    return "(" + " + ".join(f"cast(contains({text}, {quoted(k)}) as bigint)" for k in keywords) + ")"


def any_sql(text: str, keywords: list[str]) -> str:
    return "(" + " or ".join(f"contains({text}, {quoted(k)})" for k in keywords) + ")"


def values_sql(rows: list[tuple]) -> str:
    def literal(v) -> str:
        return "null" if v is None else quoted(v) if isinstance(v, str) else repr(v)

    return "(values " + ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows) + ")"


RELEVANCE_SQL = f"""
first_comments as (
 select post_id, string_agg(lower(body), ' ' order by comment_rank) as words from ranked_comments
 where comment_rank <= 5 and body <> '' group by post_id),
keyword_counts as (
 select p.*, {count_sql(TEXT, SOURCE)} as s, {count_sql(TEXT, DESTINATION)} as d, {count_sql(TEXT, IMPLEMENTATION)} as i,
  {' + '.join(f"cast(regexp_matches({TEXT}, {quoted('(?i)' + p)}) as bigint)" for p in PATTERNS)} as p,
  coalesce({count_sql('c.words', RULES.keywords)}, 0) as c
 from posts p left join first_comments c on p.id = c.post_id),
relevance as (
 select *, cast((s + d + i) * 10 + p * 15 + case when s > 0 and d > 0 then 25 else 0 end
  + case when i > 0 and (s > 0 or d > 0) then 20 else 0 end + c * 5 as bigint) as relevance_score
 from keyword_counts)
"""


def engagement_sql(source: str, weights: dict[str, float], name: str = "engaged") -> str:
    w = {k: f"{v}e0" for k, v in weights.items()}
    return f"""
{name}_quality as (
 select post_id, {clamp_sql('(avg(score) + max(score)) * 5')} as quality, count(*) as collected
 from ranked_comments group by post_id),
{name}_tops as (select max(score) as s, max(num_comments) as n from {source}),
{name}_parts as (
 select r.*, {clamp_sql('score / (case when t.s > 0 then t.s else 1 end) * 100')} as score_normalized,
  {clamp_sql('upvote_ratio * 100')} as upvote_ratio_normalized,
  {clamp_sql('num_comments / (case when t.n > 0 then t.n else 1 end) * 100')} as comments_normalized,
  coalesce(q.quality, 0e0) as comment_quality_score, coalesce(q.collected, 0) as comments_collected,
  {clamp_sql('100 - hours_ago / 24 * 50')} as recency_score
 from {source} r cross join {name}_tops t left join {name}_quality q on r.id = q.post_id),
{name} as (
 select *, {half_even_sql(f'0e0 + score_normalized * {w["score"]} + upvote_ratio_normalized * {w["upvote_ratio"]}'
                          f' + comments_normalized * {w["comments"]} + comment_quality_score * {w["comments_quality"]}'
                          f' + recency_score * {w["recency"]}', 2)} as engagement_score
 from {name}_parts)
"""


def phrase_sql(name: str, lexicon: Lexicon) -> str:
    """CTE ``{name}_v4``: idioms and phrase boosters around the tokens of ``{name}_v3``, and "least" before them."""

    def run(*steps: int) -> str:
        return " || ' ' || ".join(f"lower(n{s})" if s > 0 else "token" if s == 0 else f"lower(b{-s})" for s in steps)

    def looked_up(table: dict[str, float], *steps: int) -> str:
        return f"case {run(*steps)} " + " ".join(f"when {quoted(k)} then {v}e0" for k, v in table.items()) + " end"

    idioms, boosters = dict(lexicon.idioms), lexicon.phrase_boosters
    around = [(0, 1, 2), (0, 1), (-1, 0), (-2, -1, 0), (-2, -1), (-3, -2, -1), (-3, -2)]
    replaced = f"coalesce({', '.join(looked_up(idioms, *s) for s in around)}, v3)" + "".join(
        f" + coalesce({looked_up(boosters, *s)}, 0e0)" for s in ((-3, -2, -1), (-3, -2), (-2, -1))
    )
    valued = ", ".join(quoted(w) for w in lexicon.scored)
    return f"""
{name}_v4 as (
 select *, (case when b3 is not null and lower(b3) not in ({valued}) then {replaced} else v3 end)
  * case when lower(b1) = 'least' and coalesce(lower(b2), '') not in ('at', 'very') then -0.74e0 else 1e0 end as v4
 from {name}_v3 where not (token = 'kind' and lower(coalesce(n1, '')) = 'of')),"""


def sentiment_sql(source: str, key: str, text: str, name: str, words: Lexicon = LEXICON) -> str:
    """CTEs ``{name}_hits`` and ``{name}`` scoring the texts of a source with a unique key."""
    lexicon = values_sql(list(words.scored.items()))
    phrases = phrase_sql(name, words) if words.idioms else ""
    negations = ", ".join(quoted(n) for n in words.modifiers[1])
    valued = ", ".join(quoted(w) for w in words.scored)
    negated_by_no = (
        "(case when lower(b1) = 'no' or lower(b2) = 'no' or (lower(b3) = 'no' and lower(b1) in ('or', 'nor')) then -0.74e0"
        f" when lower(t) = 'no' and lower(coalesce(n1, '')) in ({valued}) then 0e0 else 1e0 end)" if "no" in words.scored else "1e0"
    )
    caps = "(t = upper(t) and t <> lower(t))"

    def step(level: int, damping: str) -> str:
        before, near = f"v{level - 1}", f"b{level}"
        boost = (
            f"(case when {before} < 0 then -0.293e0 else 0.293e0 end + case when mixed and ({near} = upper({near})) "
            f"then case when {before} > 0 then 0.733e0 else -0.733e0 end else 0e0 end) * {damping}"
        )
        return (
            f"({before} + case when lower({near}) = 'thth' then {boost} else 0e0 end)"
            f" * case {never(level)} when lower({near}) in ({negations}) then -0.74e0 else 1e0 end as v{level}"
        )

    def never(level: int) -> str:
        between = [f"lower(b{k})" for k in range(1, level)]
        if "never" not in words.negations or not between:
            return ""
        so = " or ".join(f"{b} in ('so', 'this')" for b in between)
        doubt = " or ".join(f"{b} = 'doubt'" for b in between)
        return f"when lower(b{level}) = 'never' and ({so}) then 1.25e0 when lower(b{level}) = 'without' and ({doubt}) then 1e0"

    def java(pattern: str) -> str:
        return quoted(pattern.replace("(?d)", ""))

    cleaned = text
    for pattern, to in ((URL_PATTERN, "''"), (HANDLE_PATTERN, "''"), (SYMBOL_PATTERN, "' '"), (SPACES_PATTERN, "' '")):
        cleaned = f"regexp_replace({cleaned}, {java(pattern)}, {to}, 'g')"
    total = "coalesce(total, 0e0)"
    up, down = "coalesce(up, 0e0)", "coalesce(down, 0e0)"
    return f"""
{name}_clean as (select {key} as k, trim({cleaned}) as c from {source}),
{name}_split as (
 select k, unnest(l) as w, generate_subscripts(l, 1) as i from (select k, string_split(c, ' ') as l from {name}_clean where c <> '')),
{name}_tok as (select k, i, case when length(trim(w, '.,!?_')) <= 2 then w else trim(w, '.,!?_') end as t from {name}_split),
{name}_near as (
 select k, i, t, lag(t, 1) over o as b1, lag(t, 2) over o as b2, lag(t, 3) over o as b3,
  lead(t, 1) over o as n1, lead(t, 2) over o as n2, count(*) over (partition by k) as n, sum(cast({caps} as int)) over (partition by k) as shouted,
  min(case when lower(t) = 'but' then i end) over (partition by k) as bi
 from {name}_tok window o as (partition by k order by i)),
{name}_own as (
 select k, i, t, b1, b2, b3, n1, n2, bi, shouted > 0 and shouted < n as mixed, cast(x.valence as double) * {negated_by_no} as own
 from {name}_near join {lexicon} x(token, valence) on lower(t) = x.token),
{name}_v0 as (
 select k, i, lower(t) as token, b1, b2, b3, n1, n2, bi, mixed,
  own + case when {caps} and mixed then case when own > 0 then 0.733e0 else -0.733e0 end else 0e0 end as v0 from {name}_own),
{name}_v1 as (select *, {step(1, '1e0')} from {name}_v0),
{name}_v2 as (select *, {step(2, '0.95e0')} from {name}_v1),
{name}_v3 as (select *, {step(3, '0.9e0')} from {name}_v2),
{phrases}
{name}_hits as (
 select k, i, token, {'v4' if phrases else 'v3'} * case when i < bi then 0.5e0 when i > bi then 1.5e0 else 1e0 end as v from {name}_{'v4' if phrases else 'v3'}),
{name}_sums as (
 select k, sum(v) as total, sum(case when v > 0 then v + 1 else 0e0 end) as up,
  sum(case when v < 0 then v - 1 else 0e0 end) as down, count(*) filter (v <> 0) as hits from {name}_hits group by k),
{name}_raw as (
 select a.k, c, {total} as total, {up} as up, abs({down}) as down,
  len(string_split(c, ' ')) - coalesce(hits, 0) as neutral,
  least(length(c) - length(replace(c, '!', '')), 4) * 0.292e0 + case when length(c) - length(replace(c, '?', '')) <= 1 then 0e0
   when length(c) - length(replace(c, '?', '')) <= 3 then (length(c) - length(replace(c, '?', ''))) * 0.18e0 else 0.96e0 end as marks
 from {name}_clean a left join {name}_sums b on a.k = b.k),
{name}_marked as (
 select k, c, neutral, case when total > 0 then total + marks when total < 0 then total - marks else total end as total,
  case when up > down then up + marks else up end as up, case when up < down then down + marks else down end as down
 from {name}_raw),
{name}_shares as (
 select k, case when coalesce(c, '') = '' then 0e0 else {half_even_sql('total / sqrt(total * total + 15e0)', 4)} end as compound,
  case when coalesce(c, '') = '' then 0e0 else {half_even_sql('up / (up + down + neutral)', 3)} end as pos,
  case when coalesce(c, '') = '' then 1e0 else {half_even_sql('neutral / (up + down + neutral)', 3)} end as neu,
  case when coalesce(c, '') = '' then 0e0 else {half_even_sql('down / (up + down + neutral)', 3)} end as neg
 from {name}_marked),
{name} as (
 select *, case when compound >= 0.05e0 then 'positive' when compound <= -0.05e0 then 'negative' else 'neutral' end as class,
  {half_even_sql('case when compound > 0 then least(100e0, 50 + compound * 50 + pos * 25) else greatest(10e0, 50 + compound * 30) end', 2)} as priority
 from {name}_shares)
"""


OVERALL_SQL = f"""
{sentiment_sql('posts', 'id', 'title', 'ts')},
{sentiment_sql('posts', 'id', 'selftext', 'bs')},
{sentiment_sql("(select * from ranked_comments where comment_rank <= 5 and length(body) > 10)", 'comment_id', 'body', 'cs')},
comment_moods as (
 select post_id, sum(priority) / count(*) as mood from cs join ranked_comments r on cs.k = r.comment_id group by post_id),
moods as (
 select p.*, ts.compound as title_sentiment_compound, ts.pos as title_sentiment_pos, ts.neu as title_sentiment_neu,
  ts.neg as title_sentiment_neg, ts.class as title_sentiment_class, ts.priority as title_sentiment_priority,
  case when coalesce(length(regexp_replace(selftext, '^[\\s\\x0B\\x1C-\\x1F\\x85\\p{{Z}}]+|[\\s\\x0B\\x1C-\\x1F\\x85\\p{{Z}}]+$', '', 'g')), 0) < 10
   then ts.class else bs.class end as content_sentiment_class,
  case when coalesce(length(regexp_replace(selftext, '^[\\s\\x0B\\x1C-\\x1F\\x85\\p{{Z}}]+|[\\s\\x0B\\x1C-\\x1F\\x85\\p{{Z}}]+$', '', 'g')), 0) < 10
   then ts.priority else bs.priority end as content_sentiment_priority,
  coalesce(m.mood, 50e0) as comments_sentiment_avg
 from posts p join ts on p.id = ts.k join bs on p.id = bs.k left join comment_moods m on p.id = m.post_id),
overall_scores as (
 select *, {half_even_sql('title_sentiment_priority * 0.4e0 + content_sentiment_priority * 0.35e0 + comments_sentiment_avg * 0.25e0', 2)}
  as overall_sentiment_score from moods),
overall as (
 select *, case when overall_sentiment_score >= 65 then 'positive' when overall_sentiment_score <= 35 then 'negative'
  else 'neutral' end as overall_sentiment_class from overall_scores)
"""


# ---- registration --------------------------------------------------------------------------
def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a function of :class:`Views`; ``sql`` selects from the views and ``ctes``."""

    def register(build: Callable[[Views], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = "with " + VIEW_SQL + (", " + ctes if ctes else "") + sql
        return build

    return register
