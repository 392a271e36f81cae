"""File arrival: each new report is ingested once, then the broker's tables are rebuilt."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.brokers import BROKERS
from tally.functions.values import file_name
from tally.plans.jobs import Ledger, ingest_raw, transform_broker
from tally.sources.landing import BINARY_FILE, XTB_REPORT, raw_rows


def arriving_files(ledger: Ledger, path: str, glob: str = "*.xlsx", files_per_batch: int = 1000) -> DataFrame:
    """New files of a landing directory as a stream, a bounded number per batch."""
    return (
        ledger.spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def ingest_arrivals(
    ledger: Ledger, path: str, checkpoint: str, broker: str = "xtb", glob: str = "*.xlsx",
    source: Column | None = None, rebuild: bool = True, fetched_at: datetime | None = None,
) -> StreamingQuery:
    """Ingest what has arrived since the last call and stop.

    The checkpoint picks every file up once; a batch replayed after a failure
    adds nothing, because rows are appended by content hash. Rows are stamped
    with the file's modification time unless ``fetched_at`` is given, so a
    replay stamps them alike.
    """
    kind = F.lit(XTB_REPORT) if source is None else source

    def ingest(batch: DataFrame, _batch_id: int) -> None:
        stamp = F.col("modificationTime") if fetched_at is None else F.lit(fetched_at).cast("timestamp")
        rows = raw_rows(batch.withColumn("__at", stamp), broker, kind, file_name("path"), stamp=F.col("__at"))
        ingest_raw(ledger, rows, broker, hand_on=False)

    query = (
        arriving_files(ledger, path, glob)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(ingest)
        .start()
    )
    query.awaitTermination()
    if rebuild:  # once, however many batches the arrivals took
        transform_broker(ledger, BROKERS[broker])
    return query
