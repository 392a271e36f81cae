"""Arrow batches cut by bytes, so that a task holds a few MB of text at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
TOKEN_BYTES = 2 << 20  # for tokenizers, which gain from words that repeat


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def balanced(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends a task a few MB of texts at a time; a limit that the session sets is left alone."""
    spark = df.sparkSession
    if spark.conf.get(ARROW_BYTES, None) is None:  # nothing set, which means 64 MB
        spark.conf.set(ARROW_BYTES, f"{8 << 20}b")
    return df


def byte_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices whose ``column`` holds about ``limit`` bytes; a longer value is a slice of its own.

    Arrow's pool keeps what was freed. Behind the last slice it is given back, else a worker keeps the most that any task
    took for as long as it lives.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        groups = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, stop - start)
    pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def lengths_in_bytes(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.cast(pc.fill_null(pc.binary_length(batch.column(column)), 0), pa.int64())
