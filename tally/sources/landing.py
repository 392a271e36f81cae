"""Landing directories of broker files as raw rows.

Network clients are not part of this package: responses and statements are
dropped into a directory by whatever fetched them, and land from there.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.values import file_name
from tally.schemas import BROKER_NAMES

log = logging.getLogger(__name__)

# --- fixed values: the `source` vocabulary of raw rows ---
FLEX, FLEX_EVENTS = "flex", "flex_events"
XTB_REPORT = "XTB_REPORT"
SUMMARY_PATH = "/equity/account/summary"
POSITIONS_PATH = "/equity/positions"
ORDERS_PATH = "/equity/history/orders"
DIVIDENDS_PATH = "/equity/history/dividends"
TRANSACTIONS_PATH = "/equity/history/transactions"
EVENT_PATHS = (ORDERS_PATH, DIVIDENDS_PATH, TRANSACTIONS_PATH)
SNAPSHOT_PATHS = (SUMMARY_PATH, POSITIONS_PATH)

# Column layout of Spark's binary file source, needed for streaming reads.
BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


class IncompleteFetchError(RuntimeError):
    """A batch that lacks one of the endpoints it must contain."""


def raw_rows(
    files: DataFrame, broker: str, source: Column, source_file: Column | None = None,
    fetched_at: datetime | None = None, stamp: Column | None = None,
) -> DataFrame:
    """Binary files as raw rows; all rows of a batch share one ``fetched_at`` unless ``stamp`` gives it."""
    if stamp is None:
        stamp = F.lit(fetched_at or datetime.now(UTC)).cast("timestamp")
    return files.select(
        stamp.alias("fetched_at"),
        F.lit(BROKER_NAMES[broker]).alias("broker"),
        source.alias("source"),
        F.col("content").alias("payload"),
        F.sha2(F.col("content"), 256).alias("payload_hash"),
        (F.lit("") if source_file is None else source_file).alias("source_file"),
    )


def _files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def land_files(
    spark: SparkSession, path: str | list[str], broker: str = "ibkr", source: str = FLEX,
    fetched_at: datetime | None = None,
) -> DataFrame:
    """XML statements of one kind (``flex`` or ``flex_events``)."""
    return raw_rows(_files(spark, path), broker, F.lit(source), fetched_at=fetched_at)


def land_api_dumps(
    spark: SparkSession, root: str, broker: str = "trading212", fetched_at: datetime | None = None,
    paths: Iterable[str] = (*SNAPSHOT_PATHS, *EVENT_PATHS),
) -> DataFrame:
    """JSON response pages below ``root``; the request path is the page's directory.

    ``{root}/equity/positions/0001.json`` lands with source ``/equity/positions``.
    Files of other directories are not landed.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    source = F.lit(None).cast("string")
    for p in paths:
        source = F.when(folder.endswith(p), F.lit(p)).otherwise(source)
    files = _files(spark, root).withColumn("__source", source).filter(F.col("__source").isNotNull())
    return raw_rows(files, broker, F.col("__source"), fetched_at=fetched_at)


def land_workbooks(
    spark: SparkSession, path: str | list[str], broker: str = "xtb", fetched_at: datetime | None = None
) -> DataFrame:
    """Workbook reports; ``source_file`` is the decoded base name."""
    return raw_rows(_files(spark, path), broker, F.lit(XTB_REPORT), file_name("path"), fetched_at)


def require_sources(batch: DataFrame, expected: Iterable[str] = EVENT_PATHS) -> DataFrame:
    """Raise unless the batch has rows for every expected endpoint (matched by prefix)."""
    expected = list(expected)
    seen = batch.agg(*[F.count_if(F.col("source").startswith(p)).alias(p.replace("/", "_")) for p in expected]).first()
    missing = [p for p, n in zip(expected, seen) if not n]
    if len(missing) == len(expected):
        raise IncompleteFetchError("the batch has no page of any expected endpoint")
    if missing:
        raise IncompleteFetchError("endpoints missing from the batch: " + ", ".join(missing))
    return batch
