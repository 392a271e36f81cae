"""In-place changes of stored tables: strict on schema, repeatable, with a dry run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.dedup import ADDRESS, RAW_KEY, merge_newest, orphans
from tally.operators.quality import schema_check
from tally.operators.shaping import observed, union_all
from tally.schemas import PASS, RAW
from tally.sources.lake import Lake


_ADDRESSED = T.StructType([*RAW.fields, T.StructField(ADDRESS[0], T.StringType()), T.StructField(ADDRESS[1], T.LongType())])


class SchemaConflict(RuntimeError):
    """A table whose schema is not the expected one."""


class RowConflict(RuntimeError):
    """A table holding rows that the change would lose."""


@dataclass(frozen=True)
class Change:
    """``changed`` is false when the table was absent or already in the new form."""

    changed: bool
    rows: int = 0
    written: bool = False


def _require(df: DataFrame, schema: T.StructType, where: str) -> DataFrame:
    check = schema_check(df.schema, schema)
    if check.status != PASS:
        raise SchemaConflict(f"{where}: {check.details}")
    return df


def drop_column(
    lake: Lake, layer: str, name: str, column: str, after: T.StructType, dry_run: bool = False
) -> Change:
    """Drop ``column``; what remains must be exactly ``after``."""
    table = lake.find(layer, name)
    if table is None:
        return Change(False)
    if column not in table.columns:
        _require(table, after, name)
        return Change(False)
    reduced = _require(table.drop(column), after, name)
    rows = reduced.count()
    if not dry_run:
        lake.overwrite(reduced, layer, name)
        verify(lake, layer, name, after, rows)
    return Change(True, rows, not dry_run)


def rewrite_value(
    lake: Lake, layer: str, name: str, column: str, old: str, new: str, schema: T.StructType = RAW,
    dry_run: bool = False,
) -> Change:
    """Replace one value of a text column; ``rows`` is how many rows carry it."""
    table = lake.find(layer, name)
    if table is None:
        return Change(False)
    _require(table, schema, name)
    counts = table.agg(F.count(F.lit(1)), F.count_if(F.col(column) == old)).first()
    if not counts[1]:
        return Change(False)
    if not dry_run:
        lake.overwrite(replace_value(table, column, old, new), layer, name)
        verify(lake, layer, name, schema, counts[0])
    return Change(True, counts[1], not dry_run)


def replace_value(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, F.lit(new)).otherwise(F.col(column)))


def merge_raw_tables(lake: Lake, sources: Iterable[str], destination: str, dry_run: bool = False) -> Change:
    """Merge raw tables into one, newest row per content key.

    A destination that holds keys no source has, or another schema, is never
    overwritten. Of equally old rows the one with the smallest ``source_file``
    stays. Which rows stay is decided by keys, times and addresses; a payload
    is moved once and sorted never.
    """
    frames = [f for f in (lake.find("raw", s, with_address=True) for s in sources) if f is not None]
    held = lake.find("raw", destination)
    if held is not None:
        _require(held, RAW, destination)
    if not frames:
        return Change(False)
    merged = merge_newest(union_all(frames, lake.spark, _ADDRESSED), ["source_file"], ADDRESS)
    if held is not None:
        lost = orphans(held, merged, RAW_KEY).count()
        if lost:
            raise RowConflict(f"{destination} holds {lost} key(s) that no source table has")
    if dry_run:
        return Change(True, merged.count(), False)
    counted = Observation("merged")  # as written: the sources may hold the destination itself
    lake.overwrite(merged.observe(counted, F.count(F.lit(1)).alias("rows")), "raw", destination)
    rows = verify(lake, "raw", destination, RAW, observed(counted, "rows") or 0)
    return Change(True, rows, True)


def raw_vocabulary(raw: DataFrame) -> DataFrame:
    """Rows per broker and source."""
    return raw.groupBy("broker", "source").agg(F.count(F.lit(1)).alias("rows"))


def verify(lake: Lake, layer: str, name: str, schema: T.StructType, rows: int) -> int:
    """Read the table back and compare schema and row count."""
    table = _require(lake.read(layer, name), schema, name)
    found = table.count()
    if found != rows:
        raise RowConflict(f"{name} has {found} rows after the change, expected {rows}")
    return found
