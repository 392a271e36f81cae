"""All data sets of the portfolio report, keyed by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.fernet import Key, decrypt_all
from tally.operators import report as R
from tally.operators.income import DISPLAY_ORDER, for_display
from tally.operators.quality import latest_run
from tally.schemas import CHECKED_TABLES, DATA_QUALITY
from tally.sources.lake import Lake

GOLD = ("portfolio_holdings", "dividend_income", "interest_income", "cash_flow_summary")


class NothingToReport(RuntimeError):
    """There is neither analytics data nor a quality result."""


def load_tables(lake: Lake, key: Key) -> dict[str, DataFrame]:
    """Gold tables with opened money columns, absent ones empty; plus the latest quality results."""
    tables = {}
    for name in GOLD:
        schema = CHECKED_TABLES[name].schema
        tables[name] = decrypt_all(lake.read_or_empty("analytics", name, schema), key)
    tables["data_quality"] = latest_run(lake.read_or_empty("analytics", "data_quality", DATA_QUALITY))
    return tables


def report_datasets(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Lazy data sets; nothing runs until one of them is read."""
    held, dividends = tables["portfolio_holdings"], tables["dividend_income"]
    interest, flows, quality = tables["interest_income"], tables["cash_flow_summary"], tables["data_quality"]
    counts = None
    for name in GOLD:
        one = tables[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        counts = one if counts is None else counts.unionByName(one)
    return {
        "allocation_by_broker": R.largest_first(R.allocation_by_broker(held)),
        "allocation_by_currency": R.largest_first(R.allocation_by_currency(held)),
        "positions": R.largest_first(R.positions(held)),
        "summary_by_broker": R.summary_by_broker(held).orderBy(F.col("total").desc()),
        "summary_by_type": R.summary_by_type(held).orderBy(F.col("total").desc()),
        "equity_cash_split": R.equity_cash_split(held),
        "total_value": R.total_value(held),
        "currency_allocation": R.currency_allocation(held),
        "cross_broker_tickers": R.cross_broker_tickers(held),
        "passive_income": R.passive_income(dividends, interest).orderBy("period_month", "series"),
        "passive_income_totals": R.passive_income_totals(dividends, interest),
        **{name: for_display(tables[name], name) for name in DISPLAY_ORDER},
        "cash_flow_grid": R.cash_flow_grid(flows).orderBy("event_type", "period_month"),
        "cash_flow_outliers": R.cash_flow_outliers(R.cash_flow_peaks(flows)),
        "quality_counts": R.status_counts(quality).orderBy("status"),
        "quality_results": R.latest_results_first(quality),
        "sections": R.section_visibility(counts, quality),
    }


def portfolio_report(lake: Lake, key: Key) -> dict[str, DataFrame]:
    """The report's data sets from a lake; raises when there is nothing to show."""
    tables = load_tables(lake, key)
    if all(t.isEmpty() for t in tables.values()):
        raise NothingToReport("no analytics tables; run the analytics and validation jobs first")
    return report_datasets(tables)
