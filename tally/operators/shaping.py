"""Small building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.sums import added_up, partial_sums


def conform(df: DataFrame, schema: T.StructType, **stamps: Column) -> DataFrame:
    """Columns of ``schema`` in order and type; absent ones become null.

    ``stamps`` fills named columns (``calculated_at=...``).
    """
    have = set(df.columns)

    def column(field: T.StructField) -> Column:
        if field.name in stamps:
            value = stamps[field.name]
        elif field.name in have:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select([column(f) for f in schema.fields])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def union_all(frames: Iterable[DataFrame | None], spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Union of the frames that exist, each conformed first; none gives a typed empty frame."""
    present = [conform(f, schema) for f in frames if f is not None]
    return reduce(DataFrame.unionByName, present) if present else empty(spark, schema)


def keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys under names of their own, ready for :func:`match_keys`."""
    return df.select([F.col(k).alias(f"__other_{k}") for k in keys]).distinct()


def match_keys(df: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``df`` with a :func:`keys_of` table."""
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(f"__other_{k}")) for k in keys])


def row_struct(fields: dict[str, Column], schema: T.StructType) -> Column:
    """A struct of the schema's columns; those without a field are null."""
    return F.struct(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def labelled_sum(df: DataFrame, keys: Sequence[str], labels: Sequence[str], value: str) -> DataFrame:
    """Sum of ``value`` and the smallest non-null value of each text label, per ``keys``.

    A minimum over text would force a sort of all rows. The labels are keys of a
    first, hash aggregated level instead; as a rule they do not vary within a
    group, so the second level has few rows.
    """
    fine = df.groupBy(*keys, *labels).agg(*partial_sums(df, value))
    return fine.groupBy(*keys).agg(added_up(fine, value).alias(value), *[F.min(c).alias(c) for c in labels])


def observed(observation: Observation, name: str) -> int | None:
    """An observed count; None when the run had nothing left to observe.

    Adaptive execution replaces a plan whose input turns out empty, metrics
    included, so a missing count says nothing about the rows.
    """
    try:
        return observation.get.get(name)
    except Py4JJavaError:
        return None


def total(df: DataFrame, value: Column) -> Column:
    """A whole-table aggregate as a scalar subquery: one value, no join, no window."""
    return df.agg(value.alias("total")).scalar()
