"""JSON arrays over many lines, cut into records by many tasks per file.

Spark's own reader parses such a file in one task and holds all its records there. No JSON string holds a raw line break, so
each line consists of whole tokens and says by itself how far brackets open or close. A first pass adds that up by split of
a file; a second one, which then knows how deep its split begins, cuts out the records. What of a record lies in
several splits is put together afterwards. A task holds a batch of lines and one record.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumlens.session import work_folder, write_and_read

#: What matters of a line: strings, brackets, and quotes that no string closes.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}"]')
BETWEEN = re.compile(r"[\s,﻿]*")
SPLITS = "path string, start bigint, first string, moved bigint"
PIECES = "path string, start bigint, place bigint, opens boolean, whole boolean, value string"


def _by_split(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """The lines of a task, each with the values of ``names`` that its split has."""
    for batch in batches:
        columns = batch.to_pydict()
        yield from zip(*[columns[n] for n in names], strict=True)


def _brackets(line: str) -> Iterator[tuple[int, str]]:
    for token in TOKEN.finditer(line):
        if token[0] == '"':
            raise ValueError(f"a string ends with its line: {line[:80]}")
        if token[0][0] != '"':
            yield token.start(), token[0]


def _depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split its first bracket and how far it opens."""
    found: dict[tuple, list] = {}
    for path, start, line in _by_split(batches, ["path", "start", "value"]):
        split = found.setdefault((path, start), [None, 0])
        for _, sign in _brackets(line):
            split[0] = split[0] or sign
            split[1] += 1 if sign in "[{" else -1
    rows = [{"path": p, "start": s, "first": f, "moved": m} for (p, s), (f, m) in found.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("start", pa.int64()), ("first", pa.string()), ("moved", pa.int64())]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, and pieces of those that begin or end in another split."""
    kinds = [("path", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("opens", pa.bool_()), ("whole", pa.bool_()), ("value", pa.string())]
    split, depth, opens, place, held, ready, size = None, 0, False, 0, [], [], 0

    def piece(whole: bool) -> dict:
        return {"path": split[0], "start": split[1], "place": place, "opens": opens, "whole": whole and opens, "value": " ".join(held)}

    for path, start, base, before, line in _by_split(batches, ["path", "start", "base", "before", "value"]):
        if (path, start) != split:
            if held:
                ready.append(piece(False))
            split, depth, opens, place, held = (path, start), before, False, 0, []
        low = 0
        for at, sign in _brackets(line):
            if sign in "[{":
                if depth == base or depth < base:
                    if not BETWEEN.fullmatch(line, low, at) or (sign == "[") != (depth < base):
                        raise ValueError(f"not a list of records: {line[:80]}")
                    low, opens = (at, True) if depth == base else (at + 1, opens)
                depth += 1
                continue
            depth -= 1
            if depth == base:
                held.append(line[low : at + 1])
                ready.append(piece(True))
                size, low, place, held, opens = size + len(ready[-1]["value"]), at + 1, place + 1, [], False
            elif depth < base:
                if not BETWEEN.fullmatch(line, low, at):
                    raise ValueError(f"not a list of records: {line[:80]}")
                low = at + 1
        if depth > base:
            held.append(line[low:])
        elif not BETWEEN.fullmatch(line, low):
            raise ValueError(f"not a list of records: {line[:80]}")
        if size > 1 << 22:
            yield pa.RecordBatch.from_pylist(ready, pa.schema(kinds))
            ready, size = [], 0
    if held:
        ready.append(piece(False))
    yield pa.RecordBatch.from_pylist(ready, pa.schema(kinds))


def read_arrays(spark: SparkSession, paths: str | list[str], position: str) -> DataFrame:
    """The records of UTF-8 files that each hold one array, or objects, over several lines; ``position`` orders them.

    Types are inferred. A record that isn't JSON raises, and so does a file that ends too early.
    """
    text = spark.read.text(paths)
    folders = [c for c in text.columns if c != "value"]
    lines = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", *folders)
    found = lines.select("path", "start", "value").mapInArrow(_depths, SPLITS).groupBy("path", "start").agg(F.max("first").alias("first"), F.sum("moved").alias("moved"))
    splits = write_and_read(found, "json-splits")
    unclosed = splits.groupBy("path").agg(F.sum("moved").alias("left")).where("left <> 0").first()
    if unclosed:
        raise ValueError(f"brackets don't match: {unclosed['path']}")
    order = Window.partitionBy("path").orderBy("start")
    begins = splits.select(
        "path", "start", F.coalesce(F.sum("moved").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        (F.first("first", True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == "[").cast("int").alias("base"),
    )
    known = lines.select("path", "start", "value").join(F.broadcast(begins), ["path", "start"]).where("base is not null")
    pieces = write_and_read(known.select("path", "start", "base", "before", "value").mapInArrow(_cut, PIECES), "json-pieces")
    number = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("path").orderBy("start", "place"))
    parts = pieces.where("not whole").withColumn("number", number).groupBy("path", "number")
    joined = parts.agg(F.array_sort(F.collect_list(F.struct("start", "place", "value"))).alias("p"))
    joined = joined.select("path", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["place"].alias("place"), F.array_join("p.value", " ").alias("value"))
    records = pieces.where("whole").select("path", "start", "place", "value").unionByName(joined)
    at = F.to_json(F.struct(F.col("path").alias("file_path"), F.col("start").alias("file_block_start"), "place"))
    folder = work_folder(spark, "json-records")
    records.select(F.concat(F.lit('{"at":'), at, F.lit(',"record":'), "value", F.lit("}"))).write.text(folder)
    raw = spark.read.option("mode", "FAILFAST").json(folder)
    if "record" not in raw.columns:
        return spark.createDataFrame([], "struct<>")
    place = F.struct("at.file_path", "at.file_block_start", "at.place").alias(position)
    if not folders:
        return raw.select("record.*", place)
    named = lines.select(F.col("path").alias("_path"), *folders).distinct()
    return raw.select("record.*", place).join(F.broadcast(named), F.col(position)["file_path"] == F.col("_path")).drop("_path")


__all__ = ["read_arrays"]
