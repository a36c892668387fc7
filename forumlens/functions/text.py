r"""Text normalisation.

Whitespace and word characters are spelled out, since Java's ``\s`` and ``\w`` cover ASCII only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keywords that are tested one by one; a longer list goes through an automaton.
TESTED_ONE_BY_ONE = 200

SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

URL_PATTERN = rf"(?d)http[^{SPACE}]+|www.[^{SPACE}]+"
HANDLE_PATTERN = rf"@[{WORD}]+|#[{WORD}]+"
SYMBOL_PATTERN = rf"[^{WORD}{SPACE}.,!?]"
SPACES_PATTERN = rf"[{SPACE}]+"
NON_WORD_PATTERN = rf"[^{WORD}]+"
NEITHER_WORD_NOR_STOP_PATTERN = rf"[^{WORD}.,!?]+"
SPACE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Needed wherever a computed value is used inside a lambda: the optimizer moves an expression that
    is mentioned once to that place, and there it would run again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are costly to compute, behind a generator of one row.

    A filter on a projected column is pushed below the projection together with the whole expression,
    and the text is worked through once more for every mention. It is not pushed below a generator.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def squeeze(text: Column) -> Column:
    """Every run of whitespace becomes one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES_PATTERN, " "))


def without_links(text: Column) -> Column:
    """Drop URLs, handles and hashtags. Most texts hold none, which a substring test settles faster than a pattern."""

    def without(pattern: str, *signs: str):
        def remove(t: Column) -> Column:
            seen = F.contains(t, F.lit(signs[0]))
            for sign in signs[1:]:
                seen = seen | F.contains(t, F.lit(sign))
            return F.when(seen, F.regexp_replace(t, pattern, "")).otherwise(t)

        return remove

    text = let(text, without(URL_PATTERN, "http", "www"))
    return let(text, without(HANDLE_PATTERN, "@", "#"))


def clean_for_sentiment(text: Column) -> Column:
    """Drop URLs, handles and hashtags; keep words and basic punctuation; squeeze whitespace.

    Symbols and whitespace both end up as one blank per run, so one pattern covers them.
    """
    return F.trim(F.regexp_replace(without_links(text), NEITHER_WORD_NOR_STOP_PATTERN, " "))


def ascii_apart(text: Column, pattern: str, to: str) -> Column:
    """Signs outside ASCII that a pattern finds, replaced; a text of ASCII signs only is left alone."""
    return let(text, lambda t: F.when(F.octet_length(t) == F.char_length(t), t).otherwise(F.regexp_replace(t, pattern, to)))


def combined_text(title: str = "title", body: str = "selftext") -> Column:
    """Title, a blank, body; a missing part counts as empty."""
    return F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(body), F.lit("")))


def contains_any(text: Column, keywords: list[str]) -> Column:
    """True when any keyword is a substring; a short list stops at the first hit."""
    if len(keywords) > TESTED_ONE_BY_ONE:
        return F.size(_automaton_places(text, keywords)) > 0
    return let(text, lambda t: F.exists(_literals(keywords), lambda k: F.contains(t, k)))


def matching_places(text: Column, keywords: list[str]) -> Column:
    """The places in the list, from 0 and rising, of the keywords that are substrings of the text.

    A short list is tested keyword by keyword. A longer one costs no more than one pass over the text, by an automaton
    of all keywords; the text travels to Python for that, a batch at a time.
    """
    if len(keywords) > TESTED_ONE_BY_ONE:
        return _automaton_places(text, keywords)
    words = _literals(keywords)
    places = F.sequence(F.lit(0), F.lit(len(keywords) - 1)) if keywords else F.array().cast("array<int>")
    return let(text, lambda t: F.filter(places, lambda i: F.contains(t, F.get(words, i))))


def matching(text: Column, keywords: list[str]) -> Column:
    """The keywords that are substrings of the text, in list order."""
    return F.transform(matching_places(text, keywords), lambda i: F.get(_literals(keywords), i))


def count_matching(text: Column, keywords: list[str]) -> Column:
    """How many entries of the list are substrings; an entry listed twice counts twice."""
    return F.size(matching_places(text, keywords)).cast("bigint")


def _automaton_places(text: Column, keywords: list[str]) -> Column:
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from ahocorasick import Automaton

        entries: dict[str, list[int]] = {}
        for place, word in enumerate(keywords):
            entries.setdefault(word, []).append(place)
        always, automaton = entries.pop("", []), Automaton()
        for word, places in entries.items():
            automaton.add_word(word, places)
        automaton.make_automaton()
        for batch in batches:
            out = []
            for value in batch:
                found = set() if value is None else set(always)
                if value and entries:
                    for _, places in automaton.iter(value):
                        found.update(places)
                out.append(sorted(found))
            yield pd.Series(out, dtype="object")

    find.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(find, "array<int>").asNondeterministic()(text)


def truncate_with_mark(text: Column, limit: int, mark: str) -> Column:
    return F.when(F.char_length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit(mark))).otherwise(text)


def padded_words(text: Column) -> Column:
    """Lowercased words, each with its own blank on both sides, so whole words are substrings."""
    inner = F.regexp_replace(F.lower(text), NON_WORD_PATTERN, "  ")
    return F.concat(F.lit(" "), inner, F.lit(" "))


def tier_label(name: Column) -> Column:
    """snake_case name as a title."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def _literals(values: list[str]) -> Column:
    if len(values) > TESTED_ONE_BY_ONE:
        return F.from_json(F.lit(json.dumps(values)), "array<string>")
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")
