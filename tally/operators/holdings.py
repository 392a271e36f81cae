"""Holdings across brokers: extraction, consolidation, portfolio shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.values import first_filled, round_half_even
from tally.operators.currency import convert
from tally.operators.shaping import labelled_sum, total
from tally.operators.sums import exact_sum
from tally.schemas import BROKER_NAMES, DEFAULT_TARGET


def extract_holdings(snapshot: DataFrame, broker: str) -> DataFrame:
    """A broker's snapshot as holdings; identifier is the ISIN, for XTB the ticker."""
    label = F.col("label")
    if broker == "xtb":
        label = F.trim(F.coalesce(label, F.lit("")))
        kind, code = "TICKER:", label
    else:
        kind, code = "ISIN:", F.trim(F.coalesce(F.col("isin"), F.lit("")))
    return snapshot.select(
        F.lit(BROKER_NAMES[broker]).alias("broker"),
        label.alias("ticker"),
        "security_value",
        F.coalesce("security_ccy", F.lit("")).alias("security_ccy"),
        F.when(code != "", F.concat(F.lit(kind), code)).otherwise(F.lit("")).alias("identifier"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("position_type", F.lit("EQUITY")).alias("position_type"),
    )


def _dash(column: str) -> Column:
    return first_filled(column, F.lit("-"))


def consolidate_holdings(
    holdings: DataFrame, rates: DataFrame, target: str = DEFAULT_TARGET, fetched_at: Column | None = None
) -> DataFrame:
    """One output row per holding with its value in the target currency."""
    converted = convert(holdings, "security_value", "security_ccy", rates, target, into="target_value")
    return converted.select(
        (F.current_timestamp() if fetched_at is None else fetched_at).alias("fetched_at"),
        "broker",
        "ticker",
        "security_value",
        _dash("security_ccy").alias("security_ccy"),
        "target_value",
        F.lit(target.upper()).alias("target_ccy"),
        _dash("identifier").alias("identifier"),
        _dash("description").alias("description"),
        "position_type",
    )


def percentage_of(value: Column, whole: Column) -> Column:
    """Share of ``whole`` in percent, four digits; a zero whole gives 0.

    ``whole`` appears once, so that a scalar subquery is planned once.
    """
    share = round_half_even(F.try_divide(value.cast("double"), whole.cast("double")) * F.lit(100.0), 4)
    return F.when(value.isNotNull(), F.coalesce(share, F.lit(0.0)))


def portfolio_holdings(consolidated: DataFrame) -> DataFrame:
    """Holdings with their percentage of the whole portfolio.

    The total is a scalar subquery over one pruned column.
    """
    whole = total(consolidated, exact_sum(consolidated, "target_value"))
    return consolidated.select(
        "broker", "ticker", "security_ccy", "security_value", "target_value", "target_ccy",
        percentage_of(F.col("target_value"), whole).alias("percentage"),
        "position_type", "identifier", "description",
    )


def aggregate_percentages(
    holdings: DataFrame, rates: DataFrame, target: str = DEFAULT_TARGET, *, ordered: bool = True
) -> DataFrame:
    """Share of net worth per (ticker, broker).

    Metadata is the smallest non-empty value of the group, ``-`` when there is
    none. Groups that sum to zero are dropped; a zero net worth fails the job.
    """
    labels = ("identifier", "security_ccy", "description")
    converted = convert(holdings, "security_value", "security_ccy", rates, target)
    filled = converted.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in labels})
    grouped = labelled_sum(filled, ["ticker", "broker"], labels, "converted")
    worth = total(converted, exact_sum(converted, "converted").cast("double"))
    share = F.coalesce(F.try_divide(F.col("converted").cast("double"), worth), F.raise_error(F.lit("net worth is zero")))
    shares = grouped.filter(F.col("converted") != 0).select(
        "ticker",
        (share * F.lit(100.0)).alias("percentage"),
        "broker",
        *[F.coalesce(F.col(c), F.lit("-")).alias(c) for c in labels],
    )
    return shares.orderBy(F.abs("percentage").desc()) if ordered else shares
