"""Tables that this subpackage writes on the way, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tally.sources.scratch import Scratch

ROWS_A_FILE = 5_000

_BY_APP: dict[str, Scratch] = {}


def session_scratch(spark: SparkSession) -> Scratch:
    """The tables that outlive the operator that wrote them, as its result reads them."""
    return _BY_APP.setdefault(spark.sparkContext.applicationId, Scratch(spark))


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return session_scratch(spark).new_path(f"tally-llm/{name}")


def files_for(spark: SparkSession, rows: int) -> int:
    """How many files hold narrow tables over ``rows`` rows: two a core at least, more as the rows are more."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE))


def written(df: DataFrame, name: str, scratch: Scratch | None = None, files: int | None = None) -> DataFrame:
    """The rows of ``df``, computed once and read back from a Parquet table in the shared folder.

    This cuts the lineage: a lost executor costs nothing that was written, and each later use reads the table. Its last
    stage has ``files`` tasks at most: each file makes an executor start several processes (local file systems set
    permissions by chmod), and for a moment such a child counts with all of the executor's memory.
    """
    df = df if files is None else df.coalesce(files)
    return (scratch or session_scratch(df.sparkSession)).written(df, f"tally-llm/{name}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this session has written on the way; call it once no result is read from there any more."""
    session_scratch(spark).clear()
