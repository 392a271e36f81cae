"""Sums that do not depend on how rows are dealt."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tally.operators import report as R
from tally.operators.holdings import aggregate_percentages, portfolio_holdings
from tally.operators.income import income_base, income_tables
from tally.operators.sums import added_up, exact_sum, partial_sums

from .conftest import rows

DEALS = (1, 7, 64)


def money(n, seed=1):
    rng = random.Random(seed)
    return [rng.choice((1e-6, 0.01, 1.0, 1e5, 1e11)) * rng.uniform(-1, 1) for _ in range(n)]


def dealt(df):
    """The same rows, in different orders, over different numbers of partitions."""
    return [df.orderBy(F.rand(n)).repartition(n) for n in DEALS]


def same(results):
    first, *others = [sorted(map(repr, r.collect())) for r in results]
    assert first
    return all(first == o for o in others)


def test_sums_are_equal_to_the_last_bit(spark):
    values = money(3000)
    df = spark.createDataFrame([(i % 5, v) for i, v in enumerate(values)], "k int, v double").cache()
    results = [d.groupBy("k").agg(exact_sum(d, "v").alias("s")) for d in dealt(df)]
    assert same(results)
    for k, s in rows(results[0], "k", "s"):
        assert s == float(sum(Decimal(repr(v)).quantize(Decimal("1e-12"), ROUND_HALF_UP) for v in values[k::5]))
    assert not same([d.groupBy("k").agg(F.sum("v").alias("s")) for d in dealt(df)])  # plain sums are not


def test_partial_sums_add_up_to_the_whole(spark):
    df = spark.createDataFrame([(i % 40, i % 3, v) for i, v in enumerate(money(2000))], "batch int, k int, v double")
    partial = df.groupBy("batch", "k").agg(*partial_sums(df, "v"))
    got = rows(partial.groupBy("k").agg(added_up(partial, "v").alias("s")), "k", "s")
    assert got == rows(df.groupBy("k").agg(exact_sum(df, "v").alias("s")), "k", "s")


def test_what_no_decimal_holds_still_counts(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(1, None), (2, 1.5), (2, None), (3, 1e300), (3, 0.5), (4, inf), (4, 1.0), (5, nan), (5, 2.0), (6, inf), (6, -inf), (7, -0.0), (8, 9.0e14), (8, 2.0e15)],
        "k int, v double",
    )
    got = dict(rows(df.groupBy("k").agg(exact_sum(df, "v").alias("s")), "k", "s"))
    assert (got[1], got[2], got[3], got[4], got[7], got[8]) == (None, 1.5, 1e300, inf, 0.0, 2.9e15)
    assert got[5] != got[5] and got[6] != got[6]
    empty = df.limit(0)
    assert empty.agg(exact_sum(empty, "v").alias("s")).first().s is None


def test_decimals_are_added_as_they_are(spark):
    df = spark.createDataFrame([(Decimal("0.1234567890123456"),)] * 3, "v decimal(20,16)")
    assert df.agg(exact_sum(df, "v").alias("s")).first().s == Decimal("0.3703703670370368")
    assert [c for c in df.agg(*partial_sums(df, "v")).columns] == ["v"]


def test_tables_are_equal_to_the_last_bit(spark):
    values = money(1500, 2)
    held = spark.createDataFrame(
        [("B%d" % (i % 3), "T%d" % (i % 11), "EUR", abs(v), "x", "d", ("EQUITY", "CASH")[i % 2]) for i, v in enumerate(values)],
        "broker string, ticker string, security_ccy string, security_value double, identifier string, description string, position_type string",
    ).cache()
    rates = spark.createDataFrame([("EUR", 1.0)], "ccy string, rate double")
    assert same([aggregate_percentages(d, rates, "EUR", ordered=False) for d in dealt(held)])
    gold = held.withColumns({"target_value": F.col("security_value"), "target_ccy": F.lit("EUR")}).cache()
    assert same([portfolio_holdings(d) for d in dealt(gold)])
    shares = gold.withColumn("percentage", F.col("security_value") / 3)
    for build in (R.allocation_by_broker, R.positions, R.cross_broker_tickers, R.summary_by_broker, R.total_value, R.equity_cash_split):
        assert same([build(d) for d in dealt(shares)]), build.__name__

    events = spark.createDataFrame(
        [("2025-0%d" % (1 + i % 6), "2025-Q1", "B%d" % (i % 2), ("DIVIDEND", "INTEREST", "FEE")[i % 3], "EUR", "EUR", f"T{i % 4}", v, v * 0.9, str(i)) for i, v in enumerate(values)],
        "period_month string, period_quarter string, broker string, event_type string, security_ccy string, target_ccy string, ticker string, "
        "cash_amount double, target_value double, event_id string",
    ).withColumns({"isin": F.lit("i"), "description": F.lit("d"), "instrument_ccy": F.lit("EUR")}).cache()
    for name in ("dividend_income", "interest_income", "cash_flow_summary"):
        assert same([income_tables(income_base(d))[name] for d in dealt(events)])
    for build in (R.cash_flow_grid, R.cash_flow_peaks):
        assert same([build(d) for d in dealt(events)])
    assert same([R.passive_income(d.filter("event_type = 'DIVIDEND'"), d.filter("event_type = 'INTEREST'")) for d in dealt(events)])
