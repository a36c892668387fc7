"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

MAX_CONFIG_ROWS = 10_000


def build_session(app_name: str = "forumlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts are left to adaptive execution: a generous initial number, coalesced at run
    time to the advisory size, and split again where a join partition is skewed.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, below the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a single-machine session may go
    without it; it uses one temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _temporary_folder()
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


@cache
def _temporary_folder() -> str:
    return tempfile.mkdtemp(prefix="forumlens-")


def _folder(spark: SparkSession, path: str):
    """A path and its file system, as Spark's own readers see them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Files and folders directly in a folder, by name; a folder that isn't there raises."""
    place, files = _folder(spark, path)
    return sorted(entry.getPath().toString() for entry in files.listStatus(place))


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _folder(spark, path)
    return files.exists(place)


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all: under another name first, then renamed."""
    place, files = _folder(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = files.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(part, place) and not files.exists(place):
        raise OSError(f"could not publish {path}")


def read_published(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for the time of a block, as they were afterwards; dots in names are written as __."""
    wanted = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def delete_folder(spark: SparkSession, path: str) -> None:
    place, files = _folder(spark, path)
    files.delete(place, True)


def write_and_read(df: DataFrame, label: str) -> DataFrame:
    """Materialise a frame as a parquet table in the shared folder and read it back.

    The result has no lineage to recompute, so a lost executor costs a re-read and nothing more.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_written(df: DataFrame) -> None:
    """Delete the folder of a table of :func:`write_and_read` that nothing reads any more."""
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def spread_small_input(df: DataFrame) -> DataFrame:
    """An input of fewer partitions than cores, dealt out over all of them; any other as it is.

    A small file is one row group and would keep one core busy. At scale the scan has partitions
    enough, and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
