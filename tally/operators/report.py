"""The data sets behind the portfolio report (over the small analytics tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.operators.shaping import labelled_sum, total
from tally.operators.sums import added_up, exact_sum, partial_sums

OUTLIER_RATIO = 10.0


def _share_by(holdings: DataFrame, key: str) -> DataFrame:
    return holdings.groupBy(key).agg(exact_sum(holdings, "percentage").cast("double").alias("percentage"))


def allocation_by_broker(holdings: DataFrame) -> DataFrame:
    return _share_by(holdings, "broker")


def allocation_by_currency(holdings: DataFrame) -> DataFrame:
    return _share_by(holdings, "security_ccy")


def positions(holdings: DataFrame) -> DataFrame:
    """One bar per ticker, summed over brokers."""
    summed = labelled_sum(holdings, ["ticker"], ["position_type"], "percentage")
    return summed.withColumn("percentage", F.col("percentage").cast("double"))


def largest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("percentage").desc())


def currency_allocation(holdings: DataFrame) -> DataFrame:
    """Rounded share and number of positions per currency."""
    return holdings.groupBy("security_ccy").agg(
        F.round(exact_sum(holdings, "percentage").cast("double"), 2).alias("total_pct"), F.count(F.lit(1)).alias("positions")
    )


def cross_broker_tickers(holdings: DataFrame) -> DataFrame:
    """Tickers held at more than one broker.

    Grouped per (ticker, broker) first, so a popular ticker is folded map-side.
    """
    per_broker = holdings.groupBy("ticker", "broker").agg(*partial_sums(holdings, "percentage"))
    return (
        per_broker.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("broker_count"), added_up(per_broker, "percentage").cast("double").alias("total_pct"))
        .filter(F.col("broker_count") > 1)
    )


def passive_income(dividends: DataFrame, interest: DataFrame) -> DataFrame:
    """Monthly dividends and interest, one ``series`` each."""

    def monthly(df: DataFrame, series: str) -> DataFrame:
        return df.groupBy("period_month").agg(
            F.lit(series).alias("series"), exact_sum(df, "target_value").cast("double").alias("total")
        )

    return monthly(dividends, "Dividends").unionByName(monthly(interest, "Interest"))


def passive_income_totals(dividends: DataFrame, interest: DataFrame) -> DataFrame:
    """Total dividends and total interest with their currency."""

    def overall(df: DataFrame, series: str) -> DataFrame:
        return df.agg(
            F.lit(series).alias("series"),
            exact_sum(df, "target_value").cast("double").alias("total"),
            F.min("target_ccy").alias("target_ccy"),
        )

    return overall(dividends, "Dividends").unionByName(overall(interest, "Interest"))


def cash_flow_grid(cash_flow: DataFrame) -> DataFrame:
    """Every event type in every month that occurs, 0 where there was no flow.

    The list of types is one array (the mappings give no more than their own
    vocabulary), exploded per month; months are rows, however many there are.
    """
    flows = cash_flow.groupBy("event_type", "period_month").agg(exact_sum(cash_flow, "target_value").cast("double").alias("value"))
    types = total(flows, F.array_sort(F.collect_set("event_type")))
    cells = flows.select("period_month").distinct().select(F.explode(types).alias("event_type"), "period_month")
    return cells.join(flows, ["event_type", "period_month"], "left").select(
        "event_type", "period_month", F.coalesce("value", F.lit(0.0)).alias("value")
    )


def cash_flow_peaks(cash_flow: DataFrame) -> DataFrame:
    """Largest absolute monthly value per event type."""
    flows = cash_flow.groupBy("event_type", "period_month").agg(exact_sum(cash_flow, "target_value").cast("double").alias("value"))
    return flows.groupBy("event_type").agg(F.coalesce(F.max(F.abs("value")), F.lit(0.0)).alias("peak"))


def cash_flow_outliers(peaks: DataFrame, ratio: float = OUTLIER_RATIO) -> DataFrame:
    """Flag event types whose peak dwarfs the smallest meaningful other peak.

    The baseline of a row is the smallest other non-zero peak, but at least
    ``max / ratio²``. The two smallest non-zero peaks are enough to know every
    row's smallest other one; two aggregates find them.
    """
    lowest = total(peaks, F.min(F.when(F.col("peak") > 0, F.col("peak"))))
    facts = peaks.withColumn("lowest", lowest).agg(
        F.struct(
            F.min("lowest").alias("lowest"),
            F.count_if(F.col("peak") == F.col("lowest")).alias("at_lowest"),
            F.min(F.when(F.col("peak") > F.col("lowest"), F.col("peak"))).alias("next"),
            F.max("peak").alias("highest"),
            F.count(F.lit(1)).alias("types"),
        ).alias("facts")
    ).scalar()
    first = F.col("facts.lowest")
    second = F.when(F.col("facts.at_lowest") > 1, first).otherwise(F.col("facts.next"))
    other = F.when(F.col("peak") == first, second).otherwise(first)
    floor = F.greatest("facts.highest", F.lit(0.0)) / F.lit(ratio * ratio)
    outlier = (F.col("facts.types") >= 2) & other.isNotNull() & (F.col("peak") > F.lit(ratio) * F.greatest(other, floor))
    return peaks.withColumn("facts", facts).select("event_type", "peak", F.coalesce(outlier, F.lit(False)).alias("is_outlier"))


def status_counts(quality: DataFrame) -> DataFrame:
    return quality.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def latest_results_first(quality: DataFrame) -> DataFrame:
    return quality.orderBy(F.col("checked_at").desc())


def _value_share(holdings: DataFrame, key: str) -> DataFrame:
    """Per key the value and its share of the whole, which is summed from the groups: holdings are read once."""
    grouped = holdings.groupBy(key).agg(exact_sum(holdings, "target_value").alias("value"))
    whole = F.sum("value").over(Window.partitionBy().orderBy("value", key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).cast("double")
    value = F.col("value").cast("double")
    share = F.coalesce(F.try_divide(value, whole) * F.lit(100.0), F.lit(0.0))
    return grouped.select(key, value.alias("total"), share.alias("share"))


def summary_by_broker(holdings: DataFrame) -> DataFrame:
    return _value_share(holdings, "broker")


def summary_by_type(holdings: DataFrame) -> DataFrame:
    return _value_share(holdings, "position_type")


def equity_cash_split(holdings: DataFrame) -> DataFrame:
    """Equity and cash share, one digit."""

    def share(kind: str) -> Column:
        return F.coalesce(F.bround(exact_sum(parts, kind).cast("double"), 1), F.lit(0.0))

    parts = holdings.select(*[F.when(F.col("position_type") == k, F.col("percentage")).alias(k) for k in ("EQUITY", "CASH")])
    return parts.agg(share("EQUITY").alias("equity_pct"), share("CASH").alias("cash_pct"))


def total_value(holdings: DataFrame) -> DataFrame:
    return holdings.agg(
        exact_sum(holdings, "target_value").cast("double").alias("total_value"), F.min("target_ccy").alias("target_ccy")
    )


# --- fixed values: report sections and the analytics tables each depends on ---
SECTIONS = {
    "portfolio": ("portfolio_holdings",),
    "passive_income": ("dividend_income", "interest_income"),
    "cash_flow": ("cash_flow_summary",),
}


def section_visibility(row_counts: DataFrame, quality: DataFrame) -> DataFrame:
    """Which sections show: some dependency has rows and none has a FAIL.

    ``row_counts`` is ``(table_name, rows)``.
    """
    depends = F.create_map(
        *[F.lit(v) for name, tables in SECTIONS.items() for t in tables for v in (t, name)]
    )

    def per_section(df: DataFrame, measure: Column, name: str) -> DataFrame:
        return (
            df.select(F.try_element_at(depends, F.col("table_name")).alias("section"), measure.alias(name))
            .filter(F.col("section").isNotNull())
            .groupBy("section")
            .agg(F.sum(name).alias(name))
        )

    filled = per_section(row_counts, F.col("rows"), "rows")
    failed = per_section(quality, (F.col("status") == "FAIL").cast("long"), "fails")
    return filled.join(failed, "section", "left").select(
        "section", ((F.col("rows") > 0) & (F.coalesce("fails", F.lit(0)) == 0)).alias("visible")
    )
