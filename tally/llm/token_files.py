"""Token ids as Parquet lists: dictionary-encoded ids, small row groups, page indexes.

A file holds the documents of one range of ids in ascending order. Its columns: the document's id, ``shard`` (number
of the range), ``start`` (ids before the document in its shard), ``n_tokens``, ``ids``. Ids repeat, so dictionary
encoding stores about two bytes each; ``start`` and ``n_tokens`` are read without touching ``ids``; the sorted id
column and the page index let a reader of one document skip all other pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.batches import balanced, byte_slices
from tally.llm.pieces import loaded, with_end

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
SLICE_BYTES = 1 << 20


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int | None = None,
) -> None:
    """Encode every text (null: empty), append ``end_id``, and write the files in ascending order of id.

    ``shards`` ranges of ids, as many as the session has shuffle partitions unless given. Rows without an id come
    first; rows of one id stand together, in the order of their texts' hashes. An empty table gives a folder without
    rows. The order of ranges is the order of ids, so a shard's place in the whole is known from the counts alone.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, before = loaded(tokenizer), TaskContext.get().partitionId(), 0
        for part in byte_slices(batches, "text", SLICE_BYTES):
            ids, ends = with_end(*encoder.ids(part.column("text")), end_id)
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(np.full(len(ends), shard, np.int32)),
                    pa.array(before + starts, pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.view(np.int32))),
                ],
                ["id", "shard", "start", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    in_order = narrow.repartitionByRange(shards, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    schema = T.StructType(
        [
            narrow.schema["id"],
            T.StructField("shard", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        ]
    )
    (
        in_order.mapInArrow(encode, schema)
        .withColumnRenamed("id", id_column)
        .write.option("compression", "zstd")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; select fewer columns to read fewer."""
    return spark.read.parquet(path)


def shard_starts(files: DataFrame) -> DataFrame:
    """(shard, before): ids in all earlier shards. Reads two columns of counts; one row per shard is put in order."""
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def token_digests(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, start (ids of all documents before it), n_tokens, ids_crc32, from the ids in the files.

    ``ids_crc32`` is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("shard"), batch.column("start"), pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())],
                ["id", "shard", "start", "n_tokens", "ids_crc32"],
            )

    narrow = files.select(F.col(id_column).alias("id"), "shard", "start", "ids")
    schema = T.StructType(
        [*(narrow.schema[c] for c in ("id", "shard", "start")), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    )
    return (
        narrow.mapInArrow(digest, schema)
        .join(shard_starts(files), "shard")
        .select(F.col("id").alias(id_column), (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
    )
