"""Toxicity scores: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lowers case, maps look-alike letters and digit substitutions to plain letters, and turns the rest into
blanks. Words with signs or ones beside letters are matched in every reading of them. The lexicon holds whole words and stems; a hit inside an exception phrase does not count. Weights are
log ratios of a pattern's rate in toxic and in other documents of a bounded labelled sample; a logistic curve
over the weighted hits, whole and by length, gives the score.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import unicodedata
from collections import Counter, defaultdict
from dataclasses import dataclass, replace
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts and digits or signs that stand in for a plain letter.
LOOKALIKES = dict(zip("авекмнорстухіјѕԁɡαβεικνορτυχ", "abekmhopctyxijsdgabeikvoptux", strict=True))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
SIGNS = {"@": "a", "$": "s", "!": "i"}
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "loser bracket", "idiot proof", "pond scum")
SAMPLE_PER_CLASS = 4_000
LEXICON_SIZE = 64
#: Letters of a stem.
STEM = range(5, 10)
MIN_SHARE = 0.01
MIN_GAIN = 30.0
THRESHOLD = 0.7

#: Ones of a word that are read as i or l each on its own.
ONES = 4

_SIGN_INSIDE = re.compile(r"(?<=[^\W\d_])[@$!](?=[^\W\d_])")
#: A run of signs is tried from its start only, and a stretch from its first character, so that both take linear time.
_SIGNS_AT_LETTER = re.compile(r"(?<![@$!])[@$!]++(?=[^\W\d_])|(?<=[^\W\d_])[@$]+")
_LETTER = re.compile(r"[^\W\d_]")
#: Signs and the digit that may be read in more ways than one, wide forms included.
_DOUBTFUL = re.compile("[@$!1\uff20\uff04\uff01\uff11]")
_DOUBTFUL_STRETCH = re.compile(r"(?<!\S)[^\s@$!1\uff20\uff04\uff01\uff11]*+[@$!1\uff20\uff04\uff01\uff11]\S*+")


class _Fold(dict):
    """Folded form of a code point, worked out once by rule."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()
        c = LOOKALIKES.get(c) or DIGITS.get(c) or c
        plain = unicodedata.normalize("NFKD", c)
        self[code] = out = "".join(x.lower() if x.isalpha() else "" if unicodedata.combining(x) else " " for x in plain) or " "
        return out


_FOLD = _Fold()


def fold(text: str | None) -> str:
    """Words of plain lower-case letters, each with a blank before and after it."""
    text = text or ""
    if any(s in text for s in SIGNS):
        text = _SIGN_INSIDE.sub(lambda m: SIGNS[m[0]], text)
    return f" {' '.join(text.translate(_FOLD).split())} "


@lru_cache(maxsize=1 << 14)
def variants(token: str) -> list[str]:
    """Folded readings of a stretch without blanks: as ``fold`` has it, and with its signs and each 1 read as letters.

    Digits are folded first, 1 as i and as l; then a run of signs that touches a letter, but for a ``!`` at its end.
    Of more ones than ``ONES`` all are read alike.
    """
    plain = fold(token).strip()
    token = unicodedata.normalize("NFKC", token)
    if not _DOUBTFUL.search(token) or not _LETTER.search(token if set(SIGNS).isdisjoint(token) else token.translate(_FOLD)):
        return [plain]
    ones = token.count("1")
    reads = ["i" * ones, "l" * ones] if ones > ONES else ["".join(r) for r in itertools.product("il", repeat=ones)]
    out = [plain]
    for read in dict.fromkeys(reads):
        letters = iter(read)
        word = "".join(next(letters) if c == "1" else DIGITS.get(c, c) for c in token)
        word = _SIGNS_AT_LETTER.sub(lambda m: "".join(SIGNS[c] for c in m[0]), word)
        out.append(" ".join(word.translate(_FOLD).split()))
    return list(dict.fromkeys(out))


def readings(text: str | None) -> list[list[str]]:
    """Folded stretches of a text, in as many readings as its most doubtful stretch has; the first is that of ``fold``."""
    text, every, at = text or "", [], 0
    for m in _DOUBTFUL_STRETCH.finditer(text) if _DOUBTFUL.search(text) else ():
        if len(read := variants(m[0])) > 1:
            every += [[fold(text[at : m.start()]).strip()], read]
            at = m.end()
    every = [v for v in [*every, [fold(text[at:]).strip()]] if v[0]]
    return [[v[min(k, len(v) - 1)] for v in every] for k in range(max(map(len, every), default=1))]


def patterns(word: str) -> list[str]:
    """What a lexicon may hold of a word: the whole of it, or a stem of it."""
    return [f" {word} ", *(f" {word[:k]}" for k in STEM if k <= len(word))]


@dataclass(frozen=True)
class ToxicityModel:
    weights: tuple[tuple[str, float], ...] = ()
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = 0.0
    slopes: tuple[float, float] = (0.0, 0.0)


def automaton_of(model: ToxicityModel) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in model.exceptions:
        found.add_word(fold(phrase), (len(fold(phrase)), None))
    for pattern, weight in model.weights:
        found.add_word(pattern, (len(pattern), weight))
    if len(found):
        found.make_automaton()
    return found


def features(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """Weighted hits of a whole text: their sum, and per hundred words, both as log(1 + x)."""
    every = readings(text)
    best: dict[int, float] = defaultdict(float)
    for stretches in every:
        folded = f" {' '.join(stretches)} "
        hits, safe = [], []
        for end, (size, weight) in automaton.iter(folded) if len(automaton) else ():
            (safe if weight is None else hits).append((end - size + 1, end, weight))
        # each stretch counts in the reading in which it weighs most; a pattern starts with the blank before its word
        sums: dict[int, float] = defaultdict(float)
        starts = list(itertools.accumulate((len(x) + 1 for x in stretches), initial=0)) if len(every) > 1 and hits else [0]
        for s, e, w in hits:
            if not any(a <= s and e <= b for a, b, _ in safe):
                sums[bisect.bisect_right(starts, s) - 1] += w
        for k, w in sums.items():
            best[k] = max(best[k], w)
    total = sum(best.values())
    return math.log1p(total), math.log1p(100 * total / max(1, sum(len(x.split()) for x in every[0])))


def hit_features(model: ToxicityModel):
    @F.pandas_udf("struct<total:double,rate:double>")
    def score(texts: pd.Series) -> pd.DataFrame:
        automaton = automaton_of(model)
        return pd.DataFrame([features(t, automaton) for t in texts], columns=["total", "rate"], dtype="float64")

    return score


def toxicity_score(model: ToxicityModel, text: str = "text"):
    """Score column between 0 and 1. Null and empty texts score like a text without hits."""
    bias, (total, rate) = model.bias, model.slopes

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        automaton = automaton_of(model)
        hits = np.array([features(t, automaton) for t in texts], dtype=float).reshape(-1, 2)
        return pd.Series(1 / (1 + np.exp(-(bias + hits @ np.array([total, rate])))))

    return score(F.col(text).cast("string"))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, exceptions: tuple[str, ...] = EXCEPTIONS
) -> ToxicityModel:
    """Learn the lexicon and the curve from labelled rows: ``labels`` has ``doc_id`` and ``toxic``.

    The sample is the ``per_class`` labelled documents of each class with the smallest hash of their id; only
    counts and numbers leave the executors. A document with several labels is toxic if one says so. Without
    labelled documents of both classes nothing is learnt, and every text scores 0.5.
    """
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("bad"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = marked.where("bad").orderBy(*order).limit(per_class).union(marked.where("not bad").orderBy(*order).limit(per_class))
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id")

    def words(frames):
        for f in frames:
            sums: dict[str, list] = defaultdict(lambda: [0, 0, 0.0, 0.0])
            for text, bad in zip(f["text"], f["bad"], strict=True):
                every = fold(text).split()
                plain, *others = readings(text)
                more = [w for r in others for x, y in zip(plain, r, strict=True) if x != y for w in y.split()]
                seen = Counter(p for w in every for p in patterns(w)) | Counter(p for w in dict.fromkeys(more) for p in patterns(w))
                for p, n in seen.items():
                    entry = sums[p]
                    entry[0 if bad else 1] += 1
                    entry[2 if bad else 3] += n / len(every)
            yield pd.DataFrame([(p, *e) for p, e in sums.items()], columns=["pattern", "a", "b", "bad_rate", "ok_rate"])

    sizes = {r["bad"]: r["n"] for r in chosen.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    n, m = sizes.get(True, 0), sizes.get(False, 0)
    if not n or not m:
        return ToxicityModel(exceptions=exceptions)
    seen = sample.mapInPandas(words, "pattern string, a long, b long, bad_rate double, ok_rate double").groupBy("pattern")
    counts = seen.agg(*(F.sum(c).alias(c) for c in ("a", "b", "bad_rate", "ok_rate")))
    every = F.col("a") + F.col("b")
    # twice the log-likelihood gained by two shares of documents instead of one
    gain = 2 * (F.col("a") * F.log((F.col("a") + 0.01) / (every * (n / (n + m)))) + F.col("b") * F.log((F.col("b") + 0.01) / (every * (m / (n + m)))))
    weight = F.round(F.log((F.col("bad_rate") / n + 1e-6) / (F.col("ok_rate") / m + 1e-6)), 6)
    best = counts.withColumns({"gain": F.round(gain, 6), "weight": weight}).where(f"a >= {MIN_SHARE * n} and gain >= {MIN_GAIN} and weight >= 1")
    lexicon: dict[str, float] = {}
    for r in best.orderBy(F.desc("gain"), "pattern").limit(LEXICON_SIZE * 32).collect():
        stem = r["pattern"].strip()
        if len(lexicon) < LEXICON_SIZE and not any(stem.startswith(x.strip()) or x.strip().startswith(stem) for x in lexicon):
            lexicon[r["pattern"]] = r["weight"]
    model = ToxicityModel(tuple(lexicon.items()), exceptions)
    rows = sample.select("bad", hit_features(model)("text").alias("f")).select("bad", "f.total", "f.rate").toPandas()
    x = np.column_stack([np.ones(len(rows)), rows["total"], rows["rate"]]).astype(float)
    y, share = rows["bad"].to_numpy(float), n / (n + m)
    beta = np.array([math.log(share / (1 - share)), 0.0, 0.0])
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * beta * [0, 1, 1]
        beta = beta + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-9, 0.1, 0.1]), grad)
    return replace(model, bias=float(beta[0]), slopes=(float(beta[1]), float(beta[2])))
