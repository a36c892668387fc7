"""Small parameter tables as frames or as literals."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.session import MAX_CONFIG_ROWS


def config_table(spark: SparkSession, rows: Sequence[Mapping], schema: str) -> DataFrame:
    """Caller-supplied settings as a frame: broadcast up to ``MAX_CONFIG_ROWS`` rows, joined as Spark sees fit beyond."""
    if len(rows) > MAX_CONFIG_ROWS:
        names = [field.split()[0] for field in schema.split(", ")]
        return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schema)
    literal = F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")
    return F.broadcast(spark.range(1).select(F.inline(literal)))


def word_lookup(values: Mapping[str, float]) -> Callable[[Column], Column]:
    """Word -> number inside one row, without a join."""
    return keyed_lookup({word: float(number) for word, number in values.items()}, "double")


def keyed_lookup(values: Mapping[str, object], value_type: str) -> Callable[[Column], Column]:
    """Word -> value of a Spark type inside one row, without a join.

    A map literal is searched from end to end, so the words are spread by checksum over an array of
    tiny maps: one index step, then a map of about one entry. Unknown words give null.
    """
    size = 1
    while size < 2 * max(1, len(values)):
        size *= 2
    buckets: list[dict[str, object]] = [{} for _ in range(size)]
    for word, value in values.items():
        buckets[zlib.crc32(word.encode("utf-8")) % size][word] = value
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{value_type}>>")

    def look_up(word: Column) -> Column:
        place = (F.crc32(word) % F.lit(size)).cast("int")
        return F.try_element_at(F.get(table, place), word)

    return look_up
