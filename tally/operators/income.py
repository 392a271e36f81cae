"""Event analytics: dividend income, interest income, cash-flow summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.values import event_time, period_month, period_quarter
from tally.operators.currency import _names
from tally.operators.sums import added_up, partial_sums

_PERIOD = ("period_month", "period_quarter")
DIVIDEND_KEYS = (*_PERIOD, "broker", "ticker", "isin", "description", "security_ccy")
INTEREST_KEYS = (*_PERIOD, "broker", "security_ccy")
CASH_FLOW_KEYS = (*_PERIOD, "broker", "event_type", "security_ccy")


class MissingTargetError(ValueError):
    """Events that were not converted to the target currency."""


def lacks_target() -> Column:
    return F.col("target_value").isNull() | F.col("target_ccy").isNull()


def require_target(events: DataFrame, rows: int | None = None) -> DataFrame:
    """Raise when any event of any type lacks its target value or currency.

    ``rows`` is the number of such events where it is known already.
    """
    missing = events.filter(lacks_target())
    rows = missing.count() if rows is None else rows
    if rows:
        named = _names(missing.filter(F.col("security_ccy").isNotNull()), "security_ccy")
        raise MissingTargetError(f"{rows} event(s) without target value or currency (security_ccy: {named})")
    return events


def with_periods(events: DataFrame) -> DataFrame:
    """Add ``period_month`` and ``period_quarter``; events with an unreadable time are dropped."""
    timed = events.withColumn("__at", event_time("event_datetime")).filter(F.col("__at").isNotNull())
    return timed.withColumns(
        {"period_month": period_month("__at"), "period_quarter": period_quarter("__at")}
    ).drop("__at")


def unreadable_times(events: DataFrame) -> DataFrame:
    """One row: how many events :func:`with_periods` drops."""
    return events.agg(F.count_if(event_time("event_datetime").isNull()).alias("unreadable"))


_LABELS = ("target_ccy",)
_DIVIDEND_LABELS = ("target_ccy", "instrument_ccy")
_DIVIDEND_ONLY = ("ticker", "isin", "description", "instrument_ccy")


def _fine(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First level: hash aggregated, as every text column is a key."""
    return events.groupBy(*keys).agg(
        *partial_sums(events, "cash_amount", "target_value"),
        F.count("event_id").alias("event_count"),
    )


def _coarse(fine: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Second level over few rows: sums per ``keys``, the smallest non-null value of each label."""
    return fine.groupBy(*keys).agg(
        F.coalesce(added_up(fine, "cash_amount").cast("double"), F.lit(0.0)).alias("cash_amount"),
        added_up(fine, "target_value").cast("double").alias("target_value"),
        F.sum("event_count").alias("event_count"),
        *[F.min(label).alias(label) for label in labels],
    )


def _rollup(events: DataFrame, keys: Sequence[str], labels: Sequence[str] = _LABELS) -> DataFrame:
    """Sums and event count per ``keys`` and a value per label, in two levels.

    The labels (one currency per group, as a rule) are keys of the first level,
    because a minimum over text would force a sort of every event.
    """
    return _coarse(_fine(events, [*keys, *labels]), keys, labels)


def _dividends(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == "DIVIDEND")


def _interest(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == "INTEREST")


def dividend_income(periodic: DataFrame) -> DataFrame:
    """DIVIDEND events per month, broker, security and currency."""
    return _rollup(_dividends(periodic), DIVIDEND_KEYS, _DIVIDEND_LABELS)


def interest_income(periodic: DataFrame) -> DataFrame:
    """INTEREST events per month, broker and currency."""
    return _rollup(_interest(periodic), INTEREST_KEYS)


def cash_flow_summary(periodic: DataFrame) -> DataFrame:
    """All events per month, broker, event type and currency."""
    return _rollup(periodic, CASH_FLOW_KEYS)


def income_base(periodic: DataFrame) -> DataFrame:
    """One aggregate of all events that each of the three tables follows from.

    Security columns are kept for dividends only; elsewhere they are null, so
    that they do not multiply the groups.
    """
    is_dividend = F.col("event_type") == "DIVIDEND"
    slim = periodic.withColumns({c: F.when(is_dividend, F.col(c)) for c in _DIVIDEND_ONLY})
    return _fine(slim, [*CASH_FLOW_KEYS, "target_ccy", *_DIVIDEND_ONLY])


def income_tables(base: DataFrame) -> dict[str, DataFrame]:
    """The three tables from :func:`income_base`."""
    return {
        "dividend_income": _coarse(_dividends(base), DIVIDEND_KEYS, _DIVIDEND_LABELS),
        "interest_income": _coarse(_interest(base), INTEREST_KEYS, _LABELS),
        "cash_flow_summary": _coarse(base, CASH_FLOW_KEYS, _LABELS),
    }


# display orders of the three tables
DISPLAY_ORDER = {
    "dividend_income": ("period_month", "broker", "ticker"),
    "interest_income": ("period_month", "broker", "security_ccy"),
    "cash_flow_summary": ("period_month", "broker", "event_type"),
}


def for_display(table: DataFrame, name: str) -> DataFrame:
    """An income table in its display order; only what is shown is sorted, never what is stored."""
    return table.orderBy(*DISPLAY_ORDER[name])
