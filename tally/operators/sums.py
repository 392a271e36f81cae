"""Sums of money that are the same, to the last bit, however rows are dealt over tasks.

Adding doubles rounds at every step, so a total depends on the order in which tasks end. Doubles are therefore added as
decimals, as they are written out, with twelve digits behind the point; that is exact and has no order, and the total
becomes a double again at the end.
Amounts that are decimals already are added as they are. Values that such a decimal can't hold (a quadrillion and more,
infinities, not-a-number) are added as doubles beside it and join the total at its end, as they would have before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT = "decimal(28,12)"
LIMIT = 1e15
FAR = "__far"


def _floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def _joined(near: Column, far: Column) -> Column:
    near = near.cast("double")
    return F.when(far.isNull(), near).otherwise(F.coalesce(near, F.lit(0.0)) + far)


def _split(column: str) -> tuple[Column, Column]:
    value = F.col(column).cast("double")
    fits = F.abs(value) < F.lit(LIMIT)
    return F.sum(F.when(fits, value.cast(EXACT))), F.sum(F.when(~fits, value))


def exact_sum(df: DataFrame, column: str) -> Column:
    """The sum of a column as one aggregate: a double for doubles, else what ``sum`` gives."""
    return _joined(*_split(column)) if _floating(df, column) else F.sum(column)


def partial_sums(df: DataFrame, *columns: str) -> list[Column]:
    """Sums that can be added up further: one column for each, and one for what is out of a decimal's range."""
    out = []
    for c in columns:
        if _floating(df, c):
            near, far = _split(c)
            out += [near.alias(c), far.alias(c + FAR)]
        else:
            out.append(F.sum(c).alias(c))
    return out


def added_up(partial: DataFrame, column: str) -> Column:
    """The sum of :func:`partial_sums`' rows."""
    near = F.sum(column)
    return _joined(near, F.sum(column + FAR)) if column + FAR in partial.columns else near
