"""Comments stored as text: plain JSON, and what damaged files hold instead."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens.schema import COMMENTS


def decode_comments(text: Column) -> Column:
    """JSON text to a list of comments; empty or unreadable text gives an empty list."""
    return F.coalesce(F.from_json(text, COMMENTS), F.array().cast(COMMENTS))


def _literal_to_json(texts):
    def convert(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return None
        return json.dumps(value, default=str) if isinstance(value, list) else None

    return texts.map(convert)


_literal_to_json.__annotations__ = {"texts": pd.Series, "return": pd.Series}


def repair_comments(text: Column) -> Column:
    """Read as it stands; else with quotes un-doubled; else as a Python literal; else empty.

    Only rows both readings fail on are handed to Python; all others travel there as null.
    """
    plain = F.from_json(text, COMMENTS)
    undoubled = F.replace(F.replace(text, F.lit('""'), F.lit('"')), F.lit('\\"'), F.lit('"'))
    repaired = F.from_json(undoubled, COMMENTS)
    left_over = F.when(plain.isNull() & repaired.isNull() & F.startswith(text, F.lit("[")), text)
    to_json = F.pandas_udf(_literal_to_json, "string").asNondeterministic()
    literal = F.from_json(to_json(left_over), COMMENTS)
    return F.coalesce(plain, repaired, literal, F.array().cast(COMMENTS))
