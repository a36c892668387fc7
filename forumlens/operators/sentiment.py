"""Lexicon sentiment of titles, bodies and comments, after Hutto & Gilbert (2014).

The lexicon is an input table (word, valence). As long as it fits a literal, a text is scored
inside its own row: no explode, no shuffle, no join back. A larger lexicon goes through
:func:`score_by_join`, which gives the same scores from a token table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import fixed_values as fixed
from forumlens.functions.batches import by_slices, coded, in_slices, translated
from forumlens.functions.lookup import word_lookup
from forumlens.functions.numeric import half_even
from forumlens.functions.text import ascii_apart, clean_for_sentiment, computed_once, let, strip, without_links

MAX_LITERAL_WORDS = 50_000
#: Texts that are worked through at a time.
TEXTS_AT_ONCE = 1024
#: Copies of a joined lexicon, over which the tokens of one word are dealt.
JOIN_SALTS = 16
FIELDS = ("compound", "pos", "neu", "neg", "class", "priority")
#: What a text's scores follow from: sums of valences, tokens without any, and the weight of its marks.
SUMS = pa.struct([pa.field(name, pa.float64()) for name in ("total", "up", "down", "neutral", "marks")])
SUMS_TYPE = "struct<total:double,up:double,down:double,neutral:double,marks:double>"
#: Words that rules name; and signs that words don't hold, which part them like blanks: in ASCII, by byte, and others.
SPECIAL = ("but", "no", "or", "nor", "never", "so", "this", "without", "doubt", "least", "at", "very", "kind", "of")
APART = bytes(i if i > 127 or chr(i).isalnum() or chr(i) in "_.,!?" else 32 for i in range(256))
FOREIGN_SIGN_PATTERN = r"[^\p{L}\p{N}\x00-\x7F]"


@dataclass(frozen=True)
class Lexicon:
    """Valence per word, boosters with their signed step, negation words, and phrases.

    ``idioms`` gives runs of two or three words a valence that takes the place of that of a word in or just after them; a
    booster may be a run of words as well.
    """

    valence: Mapping[str, float]
    boosters: Mapping[str, float] = field(default_factory=dict)
    negations: tuple[str, ...] = ()
    idioms: Mapping[str, float] = field(default_factory=dict)

    def __post_init__(self):
        if len(self.valence) > MAX_LITERAL_WORDS:
            raise ValueError(f"over {MAX_LITERAL_WORDS} words: score with score_by_join")

    @classmethod
    def from_table(cls, table: DataFrame, boosters: Mapping[str, float], negations: tuple[str, ...]) -> Lexicon:
        """Read a (token, valence) table, refusing one too large for a literal."""
        rows = table.select("token", "valence").limit(MAX_LITERAL_WORDS + 1).collect()
        return cls({r["token"]: r["valence"] for r in rows}, boosters, negations)

    @property
    def scored(self) -> dict[str, float]:
        """Words with a valence of their own; a booster only modifies its neighbours."""
        return {w: v for w, v in self.valence.items() if w not in self.boosters}

    @property
    def modifiers(self) -> tuple[dict[str, float], list[str]]:
        """Boosters and negations that act on a following word: those without own valence."""
        return (
            {w: d for w, d in self.boosters.items() if w not in self.valence and " " not in w},
            [w for w in self.negations if w not in self.valence],
        )

    @property
    def phrase_boosters(self) -> dict[str, float]:
        return {run: d for run, d in self.boosters.items() if " " in run}


# A starter lexicon; real use supplies a table. Valences and idioms of the words in it are those published with the method.
STARTER_LEXICON = Lexicon(
    valence={
        "good": 1.9, "great": 3.1, "excellent": 2.7, "helpful": 1.8, "useful": 1.9, "easy": 1.9, "love": 3.2,
        "like": 1.5, "nice": 1.8, "reliable": 1.6, "fast": 1.2, "recommend": 1.5, "thanks": 1.9, "success": 2.7,
        "bad": -2.5, "terrible": -2.1, "awful": -2.0, "slow": -1.1, "broken": -1.9, "error": -1.4, "fail": -2.5,
        "failed": -2.3, "hate": -2.7, "problem": -1.7, "problems": -1.7, "difficult": -1.5, "expensive": -1.2,
        "frustrating": -1.9, "useless": -1.8, "wrong": -2.1,
    },
    boosters={
        "very": fixed.BOOST, "really": fixed.BOOST, "extremely": fixed.BOOST, "so": fixed.BOOST,
        "totally": fixed.BOOST, "quite": fixed.BOOST, "barely": -fixed.BOOST, "hardly": -fixed.BOOST,
        "slightly": -fixed.BOOST, "somewhat": -fixed.BOOST, "almost": -fixed.BOOST, "kind of": -fixed.BOOST, "sort of": -fixed.BOOST,
    },
    negations=("not", "never", "no", "none", "nothing", "neither", "nor", "without", "cannot", "cant", "dont"),
    idioms=fixed.IDIOMS,
)


# ---- rules shared by both forms ------------------------------------------------------------
def tokenize(cleaned: Column) -> Column:
    """Blank-separated tokens without edge punctuation; one of at most two characters is left alone."""

    def bare(token: Column) -> Column:
        inner = F.btrim(token, F.lit(fixed.EDGE_PUNCTUATION))
        return F.when(F.char_length(inner) <= 2, token).otherwise(inner)

    return F.transform(F.split(cleaned, " "), bare)


def is_caps(token: Column) -> Column:
    return (token != F.lower(token)) & (token == F.upper(token))


def mixed_case(tokens: Column, words: Column) -> Column:
    """Some tokens, but not all, are in capitals; most are settled by comparing with their lower case."""
    shouted = F.size(F.filter(tokens, lambda t, i: (t != F.get(words, i)) & (t == F.upper(t))))
    return (shouted > 0) & (shouted < F.size(tokens))


def _caps_step(token: Column, mixed: Column, valence: Column) -> Column:
    signed = F.when(valence > 0, fixed.CAPS_BOOST).otherwise(-fixed.CAPS_BOOST)
    return F.when(is_caps(token) & mixed, signed).otherwise(0.0)


def _modified(valence: Column, neighbour: Column, mixed: Column, boosters, negations: list[str]) -> Column:
    """One preceding token's effect: a damped booster step, then the negation factor.

    "never so" and "never this" strengthen instead, and "without doubt" changes nothing.
    """
    word, damping, between = neighbour["word"], neighbour["damping"], neighbour["between"]

    def apply(step: Column) -> Column:
        signed = F.when(valence < 0, -step).otherwise(step) + _caps_step(neighbour["token"], mixed, valence)
        boosted = valence + F.coalesce(signed * damping, F.lit(0.0))
        if not negations:
            return boosted
        factor = F.when(word.isin(negations), fixed.NEGATION_FACTOR)
        if "without" in negations:
            factor = F.when((word == "without") & F.arrays_overlap(between, F.array(F.lit("doubt"))), 1.0).otherwise(factor)
        if "never" in negations:
            factor = F.when((word == "never") & F.arrays_overlap(between, F.array(F.lit("so"), F.lit("this"))), fixed.NEVER_SO).otherwise(factor)
        return boosted * F.coalesce(factor, F.lit(1.0))

    return let(boosters(word), apply)


def _in_context(valence: Column, place: Column, tokens: Column, words: Column, mixed: Column, lexicon: Lexicon) -> Column:
    """Valence of the token at ``place`` after capitals and its three predecessors, nearest first."""
    boosters, negations = lexicon.modifiers
    look_up = word_lookup(boosters)
    neighbours = F.array(
        *[
            F.struct(
                F.get(tokens, place - back).alias("token"),
                F.get(words, place - back).alias("word"),
                F.lit(damping).alias("damping"),
                F.array(*[F.coalesce(F.get(words, place - b), F.lit("")) for b in range(1, back)]).cast("array<string>").alias("between"),
            )
            for back, damping in enumerate(fixed.CONTEXT_DAMPING, start=1)
        ]
    )
    start = valence + _caps_step(F.get(tokens, place), mixed, valence)
    return F.aggregate(neighbours, start, lambda v, n: _modified(v, n, mixed, look_up, negations))


def _run(words: Column, place: Column, *steps: int) -> Column:
    """The words at some steps from a place, as one text; null where one of them lies outside."""
    parts = [F.get(words, place + step) for step in steps]
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(" "), part]
    return F.concat(*spaced)


def _with_phrases(valence: Column, place: Column, words: Column, lexicon: Lexicon, own: Callable[[Column], Column]) -> Column:
    """Idioms and phrase boosters around a token, and "least" before it; ``own`` gives a word's own valence.

    Idioms are looked for from the fourth word of a text on, and not right after three words of which the first has
    a valence, as the method does.
    """
    if lexicon.idioms or lexicon.phrase_boosters:
        idiom, boost = word_lookup(lexicon.idioms), word_lookup(lexicon.phrase_boosters)
        ending = F.coalesce(*[idiom(_run(words, place, *steps)) for steps in ((-1, 0), (-2, -1, 0), (-2, -1), (-3, -2, -1), (-3, -2))])
        replaced = F.coalesce(idiom(_run(words, place, 0, 1, 2)), idiom(_run(words, place, 0, 1)), ending, valence)
        for steps in ((-3, -2, -1), (-3, -2), (-2, -1)):
            replaced = replaced + F.coalesce(boost(_run(words, place, *steps)), F.lit(0.0))
        valence = F.when((place > 2) & own(F.get(words, place - 3)).isNull(), replaced).otherwise(valence)
    if "least" in lexicon.valence:
        return valence
    before, softened = F.get(words, place - 1), F.get(words, place - 2).isin("at", "very")
    return F.when((before == "least") & ~F.coalesce(softened, F.lit(False)), valence * fixed.NEGATION_FACTOR).otherwise(valence)


def _own_valence(valence: Column, place: Column, words: Column, lexicon: Lexicon, own: Callable[[Column], Column]) -> Column:
    """A word's valence before its context: "no" with a valence of its own negates, and counts only where it stands alone."""
    if "no" not in lexicon.scored:
        return valence
    at = lambda step: F.coalesce(F.get(words, place + step), F.lit(""))
    negated = (at(-1) == "no") | (at(-2) == "no") | ((at(-3) == "no") & at(-1).isin("or", "nor"))
    factor = F.when(negated, fixed.NEGATION_FACTOR).otherwise(1.0)
    alone = (at(0) != "no") | own(F.get(words, place + 1)).isNull()
    return F.when(alone | negated, valence * factor).otherwise(0.0)


def _but_factor(place: Column, but_place: Column) -> Column:
    before, after = fixed.BUT_FACTORS
    return (
        F.when((but_place >= 0) & (place < but_place), before)
        .when((but_place >= 0) & (place > but_place), after)
        .otherwise(1.0)
    )


def _count_char(text: Column, char: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))


def emphasis(cleaned: Column) -> Column:
    """The weight of exclamation and question marks."""
    exclaim = F.least(_count_char(cleaned, "!"), F.lit(fixed.EXCLAMATION_MAX)) * fixed.EXCLAMATION_STEP
    questions = _count_char(cleaned, "?")
    ask = (
        F.when(questions <= 1, 0.0)
        .when(questions <= 3, questions * fixed.QUESTION_STEP)
        .otherwise(fixed.QUESTION_MAX)
    )
    return exclaim + ask


def classify(compound: Column) -> Column:
    return F.when(compound >= 0.05, "positive").when(compound <= -0.05, "negative").otherwise("neutral")


def priority(compound: Column, pos: Column) -> Column:
    """0-100, leaning to the positive; the negative end stops at 10."""
    up = F.least(F.lit(100.0), 50 + compound * 50 + pos * 25)
    down = F.greatest(F.lit(10.0), 50 + compound * 30)
    return half_even(F.when(compound > 0, up).otherwise(down), 2)


def _scores(total: Column, up: Column, down: Column, neutral: Column, marks: Column) -> Column:
    """Closed form from the valence sum, the positive and negative shares, and the emphasis."""
    emphasised = F.when(total > 0, total + marks).when(total < 0, total - marks).otherwise(total)
    pos_sum = F.when(up > F.abs(down), up + marks).otherwise(up)
    neg_sum = F.abs(F.when(up < F.abs(down), down - marks).otherwise(down))
    everything = pos_sum + neg_sum + neutral

    def parts(t: Column) -> Column:
        return F.struct(
            half_even(t / F.sqrt(t * t + fixed.COMPOUND_ALPHA), 4).alias("compound"),
            half_even(pos_sum / everything, 3).alias("pos"),
            half_even(neutral / everything, 3).alias("neu"),
            half_even(neg_sum / everything, 3).alias("neg"),
        )

    def labelled(s: Column) -> Column:
        return F.struct(
            s["compound"].alias("compound"), s["pos"].alias("pos"), s["neu"].alias("neu"), s["neg"].alias("neg"),
            classify(s["compound"]).alias("class"), priority(s["compound"], s["pos"]).alias("priority"),
        )

    return let(let(emphasised, parts), labelled)


def blank_scores() -> Column:
    return F.struct(
        F.lit(0.0).alias("compound"), F.lit(0.0).alias("pos"), F.lit(1.0).alias("neu"), F.lit(0.0).alias("neg"),
        F.lit("neutral").alias("class"), F.lit(50.0).alias("priority"),
    )


# ---- in-row form ---------------------------------------------------------------------------
def token_valences(cleaned: Column, lexicon: Lexicon) -> Column:
    """array<struct<place, token, valence>> of the tokens that carry sentiment, in context."""
    look_up = word_lookup(lexicon.scored)

    def hits(tokens: Column, words: Column) -> Column:
        valued = F.filter(
            F.transform(words, lambda w, i: F.struct(i.alias("place"), look_up(w).alias("valence"))),
            lambda h: h["valence"].isNotNull(),
        )
        if "kind" in lexicon.scored:  # "kind of" has no valence
            valued = F.filter(valued, lambda h: ~F.coalesce(_run(words, h["place"], 0, 1) == "kind of", F.lit(False)))
        but_place = (F.array_position(words, F.lit("but")) - 1).cast("int")

        def score(mixed: Column, but: Column) -> Column:
            return F.transform(
                valued,
                lambda h: F.struct(
                    h["place"].alias("place"),
                    F.get(words, h["place"]).alias("token"),
                    (
                        _with_phrases(
                            _in_context(_own_valence(h["valence"], h["place"], words, lexicon, look_up), h["place"], tokens, words, mixed, lexicon),
                            h["place"], words, lexicon, look_up,
                        )
                        * _but_factor(h["place"], but)
                    ).alias("valence"),
                ),
            )

        return let(mixed_case(tokens, words), lambda mixed: let(but_place, lambda but: score(mixed, but)))

    return let(tokenize(cleaned), lambda tokens: let(F.transform(tokens, F.lower), lambda words: hits(tokens, words)))


def sentiment_tokens(df: DataFrame, text: str, lexicon: Lexicon, keys: list[str]) -> DataFrame:
    """One row per token that carries sentiment, with its valence in context."""
    scored = df.select(*keys, F.inline(token_valences(clean_for_sentiment(F.col(text)), lexicon)))
    return scored.select(*keys, F.col("place").alias("token_place"), "token", "valence")


# ---- by batches ----------------------------------------------------------------------------
def _prepared(text: Column) -> Column:
    """Without URLs and handles; signs outside ASCII that no word holds are blanks. ASCII signs are left to the batches."""
    return ascii_apart(without_links(text), FOREIGN_SIGN_PATTERN, " ")


class Rules:
    """The rules of :func:`token_valences` for some texts at a time; only tokens that carry sentiment are looked at one by one."""

    def __init__(self, lexicon: Lexicon):
        scored, phrases = lexicon.scored, {**lexicon.idioms, **lexicon.phrase_boosters}
        boosters, negations = lexicon.modifiers
        known = {*scored, *boosters, *negations, *SPECIAL, *(word for run in phrases for word in run.split(" "))}
        #: Words that rules know, numbered; the number after the last is any other word, or none.
        self.number = {word: i for i, word in enumerate(sorted(known))}
        self.other, self.names = len(self.number), pa.array(list(self.number), pa.string())
        self.carries, self.valence = self._table(scored)
        self.boosts, self.step = self._table(boosters)
        self.negates, _ = self._table(dict.fromkeys(negations, 1.0))
        self.idioms, self.boosters = self._runs(lexicon.idioms), self._runs(lexicon.phrase_boosters)
        self.never, self.without = "never" in negations, "without" in negations
        self.kind, self.no = "kind" in scored, "no" in scored
        self.phrases, self.least = bool(phrases), "least" not in lexicon.valence

    def _table(self, values: Mapping[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """Whether a word of a number has a value, and which."""
        has, value = np.zeros(self.other + 1, bool), np.zeros(self.other + 1)
        for word, x in values.items():
            has[self.number[word]], value[self.number[word]] = True, x
        return has, value

    def _runs(self, values: Mapping[str, float]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length, the runs of words as one number each, in order, and their values."""
        found: dict[int, list[tuple[int, float]]] = {}
        for run, x in values.items():
            words = [np.array([self.number[word]]) for word in run.split(" ")]
            if len(words) in (2, 3):
                found.setdefault(len(words), []).append((int(self._key(words)[0]), float(x)))
        return {n: tuple(np.array(part) for part in zip(*sorted(pairs), strict=True)) for n, pairs in found.items()}

    def _key(self, words: list[np.ndarray]) -> np.ndarray:
        key = words[0].astype(np.int64)
        for word in words[1:]:
            key = key * (self.other + 1) + word
        return key

    def _of_run(self, runs: dict[int, tuple[np.ndarray, np.ndarray]], words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Whether runs of words have a value, and which."""
        key = self._key(words)
        keys, values = runs.get(len(words), (np.array([-1]), np.zeros(1)))
        near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return keys[near] == key, values[near]

    def is_word(self, numbers: np.ndarray, *words: str) -> np.ndarray:
        return np.isin(numbers, [self.number[word] for word in words])

    def sums(self, texts: pa.Array) -> pa.Array:
        """What :func:`_scores` takes, of each text; null where no token is left."""
        spaced = translated(texts, APART)
        row, code, found = coded(spaced)
        tokens = len(code)
        count = np.bincount(row, minlength=len(texts))
        number, caps = self._tokens(found)
        marks = (1 * self.carries[number] + 2 * caps + 4 * self.is_word(number, "but")).astype(np.uint8)[code]
        shouted = np.bincount(row[(marks & 2) > 0], minlength=len(texts))
        mixed = (shouted > 0) & (shouted < count)
        starts, but = np.cumsum(count) - count, np.full(len(texts), tokens)
        but_at = np.flatnonzero(marks & 4)[::-1]
        but[row[but_at]] = but_at  # the first of a text is put in last
        hit = np.flatnonzero(marks & 1)

        def at(step: int) -> tuple[np.ndarray, np.ndarray]:
            """Number and capitals of the word at some steps from each hit."""
            place = hit + step
            inside = (place >= starts[row[hit]]) & (place < starts[row[hit]] + count[row[hit]])
            there = code[np.where(inside, place, 0)] if tokens else place
            return np.where(inside, number[there], self.other), inside & caps[there]

        if self.kind and len(hit):  # "kind of" has no valence
            hit = hit[~(self.is_word(at(0)[0], "kind") & self.is_word(at(1)[0], "of"))]
        near = {step: at(step) for step in range(-3, 3)} if len(hit) else {}
        value = self._valences(near, mixed[row[hit]], hit - starts[row[hit]]) if len(hit) else np.zeros(0)
        before, after = fixed.BUT_FACTORS
        has_but, first_but = but[row[hit]] < tokens, but[row[hit]]
        value = value * np.where(has_but & (hit < first_but), before, np.where(has_but & (hit > first_but), after, 1.0))
        # each is added up in the order of a text's tokens
        total, up, down = (
            np.bincount(row[hit], weights=x, minlength=len(texts))
            for x in (value, np.where(value > 0, value + 1, 0.0), np.where(value < 0, value - 1, 0.0))
        )
        neutral = count - np.bincount(row[hit[value != 0]], minlength=len(texts))
        parts = [total, up, down, neutral, self._emphasis(spaced)]
        return pa.StructArray.from_arrays([pa.array(x.astype(np.float64)) for x in parts], fields=list(SUMS), mask=pa.array(count == 0))

    def _tokens(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of distinct words with their edges: the number without them, and whether it is all in capitals."""
        inner = pc.utf8_trim(found, fixed.EDGE_PUNCTUATION)
        tokens = pc.if_else(pc.less_equal(pc.utf8_length(inner), 2), found, inner)
        lower, upper = pc.ascii_lower(tokens), pc.ascii_upper(tokens)
        foreign = pc.invert(pc.string_is_ascii(tokens))
        if pc.any(foreign).as_py():
            some = tokens.filter(foreign).to_pylist()
            lower = pc.replace_with_mask(lower, foreign, pa.array([t.lower() for t in some], pa.string()))
            upper = pc.replace_with_mask(upper, foreign, pa.array([t.upper() for t in some], pa.string()))
        number = pc.fill_null(pc.index_in(lower, value_set=self.names), self.other)
        caps = pc.and_(pc.not_equal(tokens, lower), pc.equal(tokens, upper))
        return np.asarray(number, np.int64), np.asarray(caps, bool)

    def _valences(self, near: dict[int, tuple[np.ndarray, np.ndarray]], mixed: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Valences of tokens in context, in the order of the rules of the in-row form."""
        word = {step: number for step, (number, _) in near.items()}
        value = self.valence[word[0]]
        if self.no:
            negated = self.is_word(word[-1], "no") | self.is_word(word[-2], "no") | (self.is_word(word[-3], "no") & self.is_word(word[-1], "or", "nor"))
            alone = ~self.is_word(word[0], "no") | ~self.carries[word[1]]
            value = np.where(alone | negated, value * np.where(negated, fixed.NEGATION_FACTOR, 1.0), 0.0)

        def caps_step(step: int) -> np.ndarray:
            return np.where(near[step][1] & mixed, np.where(value > 0, fixed.CAPS_BOOST, -fixed.CAPS_BOOST), 0.0)

        value = value + caps_step(0)
        for back, damping in enumerate(fixed.CONTEXT_DAMPING, start=1):
            other, between = word[-back], [word[-b] for b in range(1, back)]
            step = self.step[other]
            signed = np.where(value < 0, -step, step) + caps_step(-back)
            value = value + np.where(self.boosts[other], signed * damping, 0.0)
            factor = np.where(self.negates[other], fixed.NEGATION_FACTOR, 1.0)
            for negation, words, instead in (("without", ["doubt"], 1.0), ("never", ["so", "this"], fixed.NEVER_SO)):
                if between and getattr(self, negation):
                    softened = np.any([self.is_word(b, *words) for b in between], axis=0)
                    factor = np.where(self.is_word(other, negation) & softened, instead, factor)
            value = value * factor
        if self.phrases:
            replaced, settled = value, np.zeros(len(value), bool)
            for steps in ((0, 1, 2), (0, 1), (-1, 0), (-2, -1, 0), (-2, -1), (-3, -2, -1), (-3, -2)):
                found, idiom = self._of_run(self.idioms, [word[step] for step in steps])
                replaced, settled = np.where(found & ~settled, idiom, replaced), settled | found
            for steps in ((-3, -2, -1), (-3, -2), (-2, -1)):
                found, boost = self._of_run(self.boosters, [word[step] for step in steps])
                replaced = replaced + np.where(found, boost, 0.0)
            value = np.where((place > 2) & ~self.carries[word[-3]], replaced, value)
        if self.least:
            value = np.where(self.is_word(word[-1], "least") & ~self.is_word(word[-2], "at", "very"), value * fixed.NEGATION_FACTOR, value)
        return value

    @staticmethod
    def _emphasis(texts: pa.Array) -> np.ndarray:
        """The same as :func:`emphasis`."""
        exclaim, ask = (np.asarray(pc.fill_null(pc.count_substring(texts, sign), 0), np.int64) for sign in "!?")
        asked = np.where(ask <= 1, 0.0, np.where(ask <= 3, ask * fixed.QUESTION_STEP, fixed.QUESTION_MAX))
        return np.minimum(exclaim, fixed.EXCLAMATION_MAX) * fixed.EXCLAMATION_STEP + asked


def _of_sums(sums: Column) -> Column:
    scored = _scores(sums["total"], sums["up"], sums["down"], sums["neutral"], sums["marks"])
    return F.when(sums.isNull(), blank_scores()).otherwise(scored)


def sentiment(text: Column, lexicon: Lexicon) -> Column:
    """struct<compound, pos, neu, neg, class, priority> of a text.

    Texts go through :class:`Rules` a batch at a time: lambdas of SQL functions run token by token.
    """
    sums = by_slices(Rules(lexicon).sums, SUMS, SUMS_TYPE, TEXTS_AT_ONCE)
    return let(sums(_prepared(text)), _of_sums)


def sentiments(texts: Column, lexicon: Lexicon) -> Column:
    """The same of each text of a list, in order; null for a null list."""
    rules = Rules(lexicon)

    def work(lists: pa.Array) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64))])
        sums = in_slices(rules.sums, lists.flatten(), SUMS, TEXTS_AT_ONCE)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), sums, mask=lists.is_null())

    work.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    of_lists = F.arrow_udf(work, f"array<{SUMS_TYPE}>").asNondeterministic()
    return F.transform(of_lists(F.transform(texts, _prepared)), _of_sums)


# ---- joined form ---------------------------------------------------------------------------
def score_by_join(df: DataFrame, text: str, table: DataFrame, lexicon: Lexicon, key: str = "id") -> DataFrame:
    """Scores per key for a lexicon table of any size; ``lexicon`` supplies boosters and negations.

    Each token row carries its predecessors, so no window over documents is needed; after the join
    with the lexicon only small sums per key are shuffled. ``key`` must be unique. A booster or a
    negation that has a valence of its own must be left out of ``lexicon`` by the caller. Phrases, and the rules about
    words with a valence beside each other, are left to the in-row form; a lexicon with idioms raises.
    """
    if lexicon.idioms or lexicon.phrase_boosters:
        raise ValueError("idioms and phrase boosters: score in the row")
    cleaned = computed_once(df.select(key, text), {"_clean": clean_for_sentiment(F.col(text))})
    split = computed_once(cleaned.select(key, "_clean"), {"_tokens": tokenize(F.col("_clean"))})
    lowered = computed_once(split, {"_words": F.transform("_tokens", F.lower)})
    base = computed_once(
        lowered,
        {
            "_mixed": mixed_case(F.col("_tokens"), F.col("_words")),
            "_but": (F.array_position("_words", F.lit("but")) - 1).cast("int"),
            "_marks": emphasis(F.col("_clean")),
            "_count": F.size("_tokens"),
        },
    )
    spread = base.select(
        key, "_mixed", "_but",
        F.inline(
            F.transform(
                "_words",
                lambda w, i: F.struct(
                    i.alias("place"), w.alias("token"),
                    F.slice("_tokens", F.greatest(i - 2, F.lit(1)), F.least(i + 1, F.lit(4))).alias("near"),
                ),
            )
        ),
    )
    # a common word's tokens are dealt over as many tasks as there are copies of the lexicon
    spread = spread.withColumn("_salt", F.pmod(F.xxhash64(key, "place"), F.lit(JOIN_SALTS)))
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(JOIN_SALTS - 1).cast("bigint"))
    copies = table.select("token", "valence", F.explode(salts).alias("_salt"))
    valued = spread.join(copies, ["token", "_salt"]).where(~F.col("token").isin(list(lexicon.boosters)))
    last = F.size("near") - 1
    in_context = _in_context(
        F.col("valence"), last, F.col("near"), F.transform("near", F.lower), F.col("_mixed"), lexicon
    )
    value = valued.select(key, (in_context * _but_factor(F.col("place"), F.col("_but"))).alias("v"))
    sums = value.groupBy(key).agg(
        F.sum("v").alias("total"),
        F.sum(F.when(F.col("v") > 0, F.col("v") + 1).otherwise(0.0)).alias("up"),
        F.sum(F.when(F.col("v") < 0, F.col("v") - 1).otherwise(0.0)).alias("down"),
        F.count_if(F.col("v") != 0).alias("hits"),
    )
    joined = base.select(key, "_clean", "_count", "_marks").join(sums, key, "left")
    zero = F.lit(0.0)
    scored = _scores(
        F.coalesce("total", zero), F.coalesce("up", zero), F.coalesce("down", zero),
        (F.col("_count") - F.coalesce("hits", F.lit(0))).cast("double"), F.col("_marks"),
    )
    result = F.when(F.coalesce("_clean", F.lit("")) == "", blank_scores()).otherwise(scored)
    return joined.select(key, result.alias("_s")).select(key, *[F.col("_s")[f].alias(f) for f in FIELDS])


# ---- posts ---------------------------------------------------------------------------------
def title_sentiment(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    scored = df.withColumn("_title", sentiment(F.col("title"), lexicon))
    return scored.withColumns({f"title_sentiment_{f}": F.col("_title")[f] for f in FIELDS}).drop("_title")


def content_sentiment(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Class and priority of the body; a body under ten characters takes the title's."""
    short = F.coalesce(F.char_length(strip(F.col("selftext"))) < 10, F.lit(True))
    from_title = F.struct(
        F.col("title_sentiment_class").alias("class"), F.col("title_sentiment_priority").alias("priority")
    )
    own = df.withColumn("_own", sentiment(F.when(~short, F.col("selftext")), lexicon))
    from_body = F.struct(F.col("_own")["class"].alias("class"), F.col("_own")["priority"].alias("priority"))
    scored = own.withColumn("_body", F.when(short, from_title).otherwise(from_body)).drop("_own")
    return scored.withColumns(
        {
            "content_sentiment_class": F.col("_body")["class"],
            "content_sentiment_priority": F.col("_body")["priority"],
        }
    ).drop("_body")


def comments_sentiment(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Mean priority of those of the first five comments longer than ten characters; 50 without any."""
    first = F.filter(
        F.transform(F.slice("comments", 1, 5), lambda c: c["body"]),
        lambda b: F.coalesce(F.char_length(b) > 10, F.lit(False)),
    )
    usable = (F.size(first) > 0) & (F.coalesce(F.col("comments_collected"), F.lit(0)) != 0)
    scored = df.withColumn("_moods", sentiments(F.when(usable, first), lexicon))
    priorities = F.transform("_moods", lambda s: s["priority"])
    mean = let(priorities, lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v))
    return scored.withColumn("comments_sentiment_avg", F.when(F.col("_moods").isNotNull(), mean).otherwise(50.0)).drop("_moods")


def overall_weights(has_body: bool, has_comments: bool) -> tuple[float, float, float]:
    """Weights of title, body and comments, by which of the two optional parts exist."""
    if not has_comments:
        return 0.6, 0.4, 0.0
    return (0.4, 0.35, 0.25) if has_body else (0.6, 0.0, 0.4)


def overall_sentiment(df: DataFrame, has_body: bool = True, has_comments: bool = True) -> DataFrame:
    title, body, comments = overall_weights(has_body, has_comments)
    content = F.col("content_sentiment_priority" if has_body else "title_sentiment_priority")
    score = half_even(
        F.col("title_sentiment_priority") * title + content * body + F.col("comments_sentiment_avg") * comments, 2
    )
    label = F.when(F.col("overall_sentiment_score") >= 65, "positive").when(
        F.col("overall_sentiment_score") <= 35, "negative"
    )
    return df.withColumn("overall_sentiment_score", score).withColumn(
        "overall_sentiment_class", label.otherwise("neutral")
    )


def add_sentiment(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All sentiment columns the frame's own columns allow for."""
    has_body, has_comments = "selftext" in df.columns, "comments" in df.columns
    scored = title_sentiment(df, lexicon)
    if has_body:
        scored = content_sentiment(scored, lexicon)
    if has_comments:
        scored = comments_sentiment(scored, lexicon)
    else:
        scored = scored.withColumn("comments_sentiment_avg", F.lit(50.0))
    return overall_sentiment(scored, has_body, has_comments)
