"""Token counts: batches balanced by bytes, encoded in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.batches import TOKEN_BYTES, balanced, byte_slices, lengths_in_bytes
from tally.llm.pieces import loaded


def token_counts(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", over: int = 512, slice_bytes: int = TOKEN_BYTES
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``over``).

    ``tokenizer`` is the path of a vocabulary file of the tokenizers library, present on every machine. No begin, end
    or added special tokens, no truncation; a text of any length is cut at safe places and encoded whole. Null texts
    count as empty (0 tokens), null ids stay null, repeated rows are counted each, an empty table gives an empty one,
    further columns are left behind whatever their names. No shuffle.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        for part in byte_slices(batches, "text", slice_bytes):
            n = pa.array(encoder.counts(part.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), lengths_in_bytes(part), n], ["id", "n_bytes", "n_tokens"])

    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    schema = T.StructType([narrow.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return narrow.mapInArrow(count, schema).select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit")
    )
