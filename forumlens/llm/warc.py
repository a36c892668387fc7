"""A content-addressed web archive: payload bytes once per digest, exact record headers apart, records by joins.

An archive is a folder of two tables. ``payloads`` holds each distinct payload once under its SHA-256; ``records`` holds
per page the exact header bytes of its WARC record (version line, named fields, HTTP header) and the digest. Of pages
with equal payloads of at least ``LEAST_BYTES`` the one with the smallest id is a ``response``, the others are
``revisit`` records that refer to it; shorter payloads are always responses.

Bytes travel once: a map task sends one copy of a payload, and of a payload that many pages share only the copy of
the page it is named after. Rows of such payloads are spread over slices, in proportion to their share of all
rows, so that neither writing nor reading ever has one task for a hot digest; there can't be more than ``SLICES``
extra slices in all, whatever the data. Digests are verified both ways: on writing, all copies of a digest must agree
in length and in a second hash; on reading, the digest of the stored bytes must be their name.
"""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.common import Scratch

LEAST_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
#: A digest with 1/SLICES of all rows or more counts as hot; there are at most so many.
SLICES = 1000
LINE = "\r\n"
RECORD_END = LINE * 2
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "row bigint, page_id bigint, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, slices bigint, header binary"
)
PAYLOADS = "payload_digest string, slices bigint, payload binary"


# ---- headers -------------------------------------------------------------------------------
def record_id(page_id: Column, row: Column) -> Column:
    """A name that no other record of the archive has; pages without an id have their row alone."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def _one_line(text: Column) -> Column:
    """A field's value can't hold line ends or other control characters; they are percent-encoded."""
    return F.when(~text.rlike("[\\x00-\\x1F\\x7F]"), text).otherwise(
        F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike("[\\x00-\\x1F\\x7F]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)), "")
    )


def header(record_type: Column, name: Column, refers_to: Column, uri: Column, digest: Column, n_bytes: Column, date: str) -> Column:
    """The exact bytes of a record before its payload: the named fields and the HTTP header."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), n_bytes.cast("string"), F.lit(LINE * 2))
    revisit = record_type == "revisit"
    block = F.length(http) + F.when(revisit, F.lit(0)).otherwise(n_bytes)
    fields = [
        F.lit(f"WARC/1.1{LINE}"), _field("WARC-Type", record_type), _field("WARC-Record-ID", name), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _one_line(uri)), _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, F.concat(_field("WARC-Refers-To", refers_to), _field("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        _field("Content-Type", F.lit("application/http;msgtype=response")), _field("Content-Length", block.cast("string")), F.lit(LINE),
    ]
    return F.concat(*fields, http).cast("binary")


def header_field(head: Column, name: str) -> Column:
    """The value of a named field in a record's header, null where it has none."""
    value = F.regexp_extract(head.cast("string"), f"(?s)\\A(?:(?!\\r\\n\\r\\n).)*?\\r\\n{name}: ([^\\r\\n]*)\\r\\n", 1)
    return F.nullif(value, F.lit(""))


def page_of(name: Column) -> Column:
    """The page id in a record's name."""
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]*):", 1).try_cast("bigint")


# ---- writing -------------------------------------------------------------------------------
def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", uri: str = "url", payload: str = "html", least_bytes: int = LEAST_BYTES, date: str = DATE
) -> None:
    """Write the archive of all pages, one record each, to a new folder that all executors reach.

    A null payload is empty, a null address is left out of the header. Pages without an id come last in the order
    of ids, and a revisit of such a page refers to none; of repeated rows and ids one is the response. No pages
    give an archive without records. Other columns are not read, so their names don't matter.
    """
    scratch = Scratch(pages.sparkSession, "archive")
    bytes_ = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    read = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(uri).cast("string").alias("uri"), bytes_.alias("payload"))
    _write_tables(read.withColumn("payload_digest", F.sha2("payload", 256)), path, scratch, least_bytes, date)
    scratch.drop("names", "owners")
    for _ in range(2):  # the shuffled payloads stay on disk until the driver has let go of what refers to them
        gc.collect()
        scratch.drop()
        time.sleep(0.3)


def _write_tables(digested: DataFrame, path: str, scratch: Scratch, least_bytes: int, date: str) -> None:
    names = scratch.save(
        digested.select(
            F.monotonically_increasing_id().alias("row"), "page_id", "uri", "payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.xxhash64("payload").alias("second"),
        ),
        "names",
    )
    total = names.count()
    place = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "row")
    owners = names.groupBy("payload_digest").agg(
        F.min(place).alias("first"), F.count("*").alias("n"),
        F.min("payload_bytes").alias("least"), F.max("payload_bytes").alias("most"), F.min("second").alias("low"), F.max("second").alias("high"),
    )
    agree = F.assert_true((F.col("least") == F.col("most")) & (F.col("low") == F.col("high")), F.concat(F.lit("different payloads of one digest: "), "payload_digest"))
    owners = scratch.save(
        owners.select(
            "payload_digest", F.col("first.page_id").alias("owner"), F.col("first.row").alias("owner_row"),
            F.expr(f"1 + n * {SLICES} div {max(total, 1)}").alias("slices"), agree.alias("verified"),
        ),
        "owners",
    )
    hot = F.broadcast(owners.where("slices > 1").drop("verified"))  # SLICES rows at most

    told = names.join(hot, "payload_digest", "left")
    rest = told.where("owner_row is null").drop("owner", "owner_row", "slices").join(owners.where("slices = 1").drop("verified"), "payload_digest")
    told = told.where("owner_row is not null").unionByName(rest)
    response = (F.col("row") == F.col("owner_row")) | (F.col("payload_bytes") < least_bytes)
    told = told.withColumn("record_type", F.when(response, "response").otherwise("revisit"))
    told = told.withColumn("refers_to", F.when(~response, F.col("owner")))
    head = header(
        F.col("record_type"), record_id(F.col("page_id"), F.col("row")), record_id(F.col("owner"), F.col("owner_row")), F.col("uri"),
        F.col("payload_digest"), F.col("payload_bytes"), date,
    )
    told = told.withColumn("header", head)
    told.select("row", "page_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "slices", "header").write.option("compression", "zstd").parquet(f"{path}/records")

    mine = digested.join(hot.select("payload_digest", "owner", "slices"), "payload_digest", "left")
    mine = mine.where(F.col("slices").isNull() | F.col("page_id").eqNullSafe(F.col("owner")))
    once = mine.groupBy("payload_digest").agg(F.first("payload").alias("payload"), F.coalesce(F.first("slices"), F.lit(1)).cast("long").alias("slices"))
    once.select("payload_digest", "slices", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")


# ---- reading -------------------------------------------------------------------------------
def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: ``page_id``, ``record_type``, ``refers_to``, ``header``, ``payload``, ``record``.

    ``record`` is the exact record as it stands in a WARC file, without the blank lines that end it; a revisit's has no
    payload, but ``payload`` is that of the record it refers to. A stored payload whose digest isn't its name raises.
    """
    records = spark.read.schema(RECORDS).parquet(f"{path}/records")
    payloads = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("payload_digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "payload_digest")))
    slices = payloads.select("payload_digest", sound.alias("payload"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    whole = records.withColumn("slice", F.pmod(F.xxhash64("row"), "slices")).join(slices, ["payload_digest", "slice"])
    record = F.when(F.col("record_type") == "revisit", F.col("header")).otherwise(F.concat("header", "payload"))
    return whole.select("page_id", "record_type", "refers_to", "header", "payload", record.alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """The records as WARC files, one per partition: Spark's lines of text, each ended by the two line ends of a record."""
    records.select(F.col("record").cast("string")).write.option("lineSep", RECORD_END).text(path)
