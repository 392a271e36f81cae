"""Exchange rates and conversion to the target currency."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tally.schemas import DEFAULT_TARGET

# --- fixed values: minor currency units, (major currency, units per major) ---
MINOR_UNITS = {"GBX": ("GBP", 100)}


class ConversionError(ValueError):
    """A currency that cannot be converted to the target."""


def parse_rate(text: str) -> tuple[str, float]:
    """``CCY=RATE`` to an upper-case code and a positive rate."""
    code, sep, number = text.partition("=")
    code = code.strip().upper()
    if not sep:
        raise ValueError("an FX rate is written CURRENCY=RATE")
    if not code:
        raise ValueError("the currency of an FX rate must not be empty")
    try:
        rate = float(number)
    except ValueError as exc:
        raise ValueError(f"not a number: {number!r}") from exc
    if not rate > 0 or math.isinf(rate):
        raise ValueError("an FX rate must be greater than zero")
    return code, rate


def rates_frame(
    spark: SparkSession,
    table: DataFrame | Mapping[str, float] | None = None,
    manual: Mapping[str, float] | Iterable[str] | None = None,
) -> DataFrame:
    """``(ccy, rate)``, one row per currency: table rates, manual ones in their place, minor units derived.

    A manual rate for a minor unit beats the derived one; null and zero table
    rates count as absent. Rates given as mappings become a literal relation,
    whose size the planner knows exactly.
    """
    if not isinstance(manual, Mapping):
        manual = dict(parse_rate(text) for text in manual or ())
    if table is None or isinstance(table, Mapping):
        known = _usable(table or {}) | _usable(manual)
        return _literal_rates(spark, _derived(known) | known)
    listed = table.select(F.upper("ccy").alias("ccy"), "rate", F.lit(1).alias("priority"))
    if manual:
        own = _literal_rates(spark, _usable(manual)).withColumn("priority", F.lit(0))
        listed = listed.unionByName(own)
    listed = listed.filter(F.col("rate").isNotNull() & (F.col("rate") != 0))
    best = listed.groupBy("ccy").agg(F.min_by("rate", F.struct("priority", "rate")).alias("rate"))
    return _with_minor_units(best)


def _usable(rates: Mapping[str, float]) -> dict[str, float | Decimal]:
    return {code.upper(): rate for code, rate in rates.items() if rate}


def _derived(known: Mapping[str, float | Decimal]) -> dict[str, float | Decimal]:
    return {minor: known[major] / units for minor, (major, units) in MINOR_UNITS.items() if major in known}


def _literal_rates(spark: SparkSession, rates: Mapping[str, float | Decimal]) -> DataFrame:
    exact = bool(rates) and all(isinstance(r, Decimal) for r in rates.values())
    kind = "DECIMAL(18,10)" if exact else "DOUBLE"
    if not rates:
        return spark.createDataFrame([], "ccy string, rate double")
    rows, args = [], {}
    for at, (code, rate) in enumerate(sorted(rates.items())):
        rows.append(f"(:code{at}, CAST(:rate{at} AS {kind}))")
        args |= {f"code{at}": code, f"rate{at}": rate if exact else float(rate)}
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS rates(ccy, rate)", args=args)


def _with_minor_units(best: DataFrame) -> DataFrame:
    """Expand every major-unit row into itself and its minor units; listed rates win."""
    kind = best.schema["rate"].dataType
    minors = F.array().cast(f"array<struct<ccy:string,rate:{kind.simpleString()},derived:int>>")
    for minor, (major, units) in MINOR_UNITS.items():
        made = F.array(
            F.struct(
                F.lit(minor).alias("ccy"),
                (F.col("rate") / F.lit(units)).cast(kind).alias("rate"),
                F.lit(1).alias("derived"),
            )
        )
        minors = F.when(F.col("ccy") == major, made).otherwise(minors)
    itself = F.array(F.struct("ccy", "rate", F.lit(0).alias("derived")))
    return (
        best.select(F.inline(F.concat(itself, minors)))
        .groupBy("ccy")
        .agg(F.min_by("rate", "derived").alias("rate"))
    )


def with_rate(df: DataFrame, rates: DataFrame, currency: str, alias: str = "__rate") -> DataFrame:
    """Left lookup of the rate of ``currency`` (compared in upper case).

    No broadcast hint: the planner broadcasts the rates when their known size
    is below its threshold and shuffles otherwise.
    """
    table = rates.select(F.col("ccy").alias("__ccy"), F.col("rate").alias(alias))
    return df.join(table, F.upper(df[currency]) == table["__ccy"], "left").drop("__ccy")


def convert(
    df: DataFrame, value: str, currency: str, rates: DataFrame, target: str = DEFAULT_TARGET,
    into: str = "converted",
) -> DataFrame:
    """Add ``into``: ``value`` in the target currency, exact when value and rates are decimals.

    Empty or target currency leaves the value as it is. A currency without rate
    fails the job; :func:`unconvertible` finds such currencies beforehand.
    """
    target = target.upper()
    source = F.upper(F.coalesce(F.col(currency), F.lit("")))
    missing = F.raise_error(F.concat(F.lit("no rate to " + target + " for "), source))
    amount = F.col(value)
    converted = (
        F.when((source == "") | (source == target), amount)
        .when(F.col("__rate").isNotNull(), amount * F.col("__rate"))
        .otherwise(missing)
    )
    return with_rate(df, rates, currency).withColumn(into, converted).drop("__rate")


def _names(df: DataFrame, column: str) -> list[str]:
    """All distinct values, for an error that must name each of them."""
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect()]


def unconvertible(
    df: DataFrame, currency: str, rates: DataFrame, target: str = DEFAULT_TARGET, also: Column | None = None
) -> DataFrame:
    """Distinct upper-case currencies of ``df`` that no rate converts (``also`` narrows the rows)."""
    rows = df if also is None else df.filter(also)
    codes = (
        rows.select(F.upper(F.col(currency)).alias("ccy"))
        .filter((F.col("ccy") != "") & (F.col("ccy") != target.upper()))
        .distinct()
    )
    return codes.join(rates.select("ccy"), "ccy", "left_anti")


def normalize_currency(
    events: DataFrame, rates: DataFrame, target: str = DEFAULT_TARGET, *, check: bool = True,
    observation: Observation | None = None,
) -> DataFrame:
    """Fill ``target_fx_rate``, ``target_value`` and ``target_ccy`` of every event.

    Rate: 1 for the target currency itself, else the broker's own non-zero rate,
    else the table. With ``check``, one narrow pass runs first and raises
    :class:`ConversionError` naming every currency that cannot be converted, so
    nothing is written on failure; without it the job itself fails on such a row.
    With an ``observation`` there is no extra pass: such rows get no rate and
    the run counts them as ``stuck``, for the caller to act on before it
    publishes the result.
    """
    target = target.upper()
    source = F.upper(F.coalesce(F.col("security_ccy"), F.lit("")))
    broker_rate = F.nullif(F.col("target_fx_rate"), F.lit(0))
    if check and observation is None:
        require_convertible(events, rates, target)
    message = F.concat(F.lit(f"event cannot be converted to {target} from '"), source, F.lit("'"))
    failed = F.lit(None) if observation is not None else F.raise_error(message)
    rate = (
        F.when(source == "", failed)
        .when(source == target, F.lit(1))
        .otherwise(F.coalesce(broker_rate, F.col("__rate"), failed))
    )
    amount = F.col("cash_amount")
    value = (
        F.when(source == target, amount)
        .when(broker_rate.isNotNull(), amount * F.col("target_fx_rate"))
        .otherwise(amount * F.col("__rate"))
    )
    looked_up = with_rate(events, rates, "security_ccy")
    if observation is not None:
        looked_up = looked_up.observe(observation, F.count_if(_stuck(target)).alias("stuck"))
    return looked_up.withColumns(
        {"target_fx_rate": rate, "target_value": value, "target_ccy": F.lit(target)}
    ).drop("__rate")


def _stuck(target: str) -> Column:
    """No rate applies (over rows that have been looked up)."""
    code = F.upper(F.coalesce(F.col("security_ccy"), F.lit("")))
    own_rate = F.coalesce(F.col("target_fx_rate"), F.lit(0)) != 0
    return (code == "") | ((code != target) & ~own_rate & F.col("__rate").isNull())


def require_convertible(events: DataFrame, rates: DataFrame, target: str) -> None:
    """Raise :class:`ConversionError` naming the currencies that cannot be converted."""
    narrow = with_rate(events.select("security_ccy", "target_fx_rate"), rates, "security_ccy")
    code = F.upper(F.coalesce(F.col("security_ccy"), F.lit("")))
    named = _names(narrow.filter(_stuck(target.upper())).select(code.alias("ccy")), "ccy")
    if "" in named:
        raise ConversionError("an event has no security_ccy; its amount cannot be converted")
    if named:
        raise ConversionError(f"no rate to {target} for {named}; pass CURRENCY=RATE overrides")
