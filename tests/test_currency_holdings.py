from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tally.operators import currency as X
from tally.operators import holdings as H

from .conftest import rows

HELD = "broker string, ticker string, security_value double, security_ccy string, identifier string, description string, position_type string"


def test_parse_rate():
    assert X.parse_rate(" usd=0.92") == ("USD", 0.92)
    for bad in ("USD", "=1", "USD=x", "USD=0", "USD=-1", "USD=nan"):
        with pytest.raises(ValueError):
            X.parse_rate(bad)


def test_rates_from_mappings(spark):
    got = dict(rows(X.rates_frame(spark, {"usd": 0.9, "GBP": 1.2, "ZZZ": 0.0}, ["USD=0.8"])))
    assert got == {"USD": 0.8, "GBP": 1.2, "GBX": 0.012}
    assert dict(rows(X.rates_frame(spark, None, {"GBX": 0.5, "GBP": 1.2}))) == {"GBX": 0.5, "GBP": 1.2}
    exact = X.rates_frame(spark, manual={"GBP": Decimal("1.15")})
    assert dict(rows(exact)) == {"GBP": Decimal("1.15"), "GBX": Decimal("0.0115")}


def test_rates_from_a_table(spark):
    table = spark.createDataFrame([("usd", 0.9), ("GBP", 1.2), ("ZZZ", 0.0), ("NUL", None)], "ccy string, rate double")
    assert dict(rows(X.rates_frame(spark, table, ["USD=0.8"]))) == {"USD": 0.8, "GBP": 1.2, "GBX": 0.012}


def test_literal_rates_are_broadcast_by_known_size(spark):
    df = spark.range(10).select(F.concat(F.lit("U"), "id").alias("c"), F.lit(1.0).alias("v"))
    plan = X.convert(df, "v", "c", X.rates_frame(spark, {"USD": 0.9}))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_convert(spark):
    df = spark.createDataFrame([(100.0, "USD"), (100.0, "gbx"), (100.0, "EUR"), (100.0, ""), (100.0, None), (None, "USD")], "v double, c string")
    got = X.convert(df, "v", "c", X.rates_frame(spark, {"USD": 0.9, "GBP": 1.2}), "eur")
    assert sorted((r.c or "", round(r.converted, 9)) for r in got.collect() if r.v is not None) == [
        ("", 100.0), ("", 100.0), ("EUR", 100.0), ("USD", 90.0), ("gbx", 1.2),
    ]
    with pytest.raises(Exception, match="no rate to EUR for CHF"):
        X.convert(spark.createDataFrame([(1.0, "chf")], "v double, c string"), "v", "c", X.rates_frame(spark)).collect()


EVENTS = "id int, security_ccy string, cash_amount double, target_fx_rate double, target_value double, target_ccy string"


def test_normalize_currency_order_of_rates(spark):
    df = spark.createDataFrame(
        [(1, "EUR", 10.0, 0.5, None, None), (2, "USD", 10.0, 0.8, None, None), (3, "usd", 10.0, 0.0, None, None),
         (4, "GBX", 100.0, None, None, None), (5, "USD", None, 0.8, None, None)],
        EVENTS,
    )
    got = X.normalize_currency(df, X.rates_frame(spark, {"USD": 0.9, "GBP": 1.2}))
    assert [(a, b, c if c is None else round(c, 9), d) for a, b, c, d in rows(got, "id", "target_fx_rate", "target_value", "target_ccy")] == [
        (1, 1.0, 10.0, "EUR"), (2, 0.8, 8.0, "EUR"), (3, 0.9, 9.0, "EUR"), (4, 0.012, 1.2, "EUR"), (5, 0.8, None, "EUR"),
    ]


def test_normalize_currency_names_every_failing_currency(spark):
    df = spark.createDataFrame([(1, "CHF", 1.0, None, None, None), (2, "nok", 1.0, 0.0, None, None), (3, "SEK", 1.0, 0.1, None, None)], EVENTS)
    with pytest.raises(X.ConversionError, match=r"\['CHF', 'NOK'\]"):
        X.normalize_currency(df, X.rates_frame(spark))
    for code in ("", None):
        blank = spark.createDataFrame([(1, code, 1.0, 0.5, None, None)], EVENTS)
        with pytest.raises(X.ConversionError, match="no security_ccy"):
            X.normalize_currency(blank, X.rates_frame(spark))


def golden(spark):
    return spark.createDataFrame(
        [
            ("IBKR", "AAPL", 3000.0, "USD", "ISIN:US0378331005", "Apple Inc", "EQUITY"),
            ("IBKR", "CASH EUR", 2000.0, "EUR", "", "Cash EUR", "CASH"),
            ("Trading 212", "CASH PLN", 1500.0, "PLN", "", "Cash PLN", "CASH"),
            ("Trading 212", "VWCEl_EQ", 2500.0, "EUR", "ISIN:IE00BK5BQT80", "", "EQUITY"),
        ],
        HELD,
    )


def test_consolidation_golden(spark):
    got = H.consolidate_holdings(golden(spark), X.rates_frame(spark, {"USD": 0.9, "PLN": 0.25}))
    assert rows(got, "ticker", "target_value", "target_ccy", "identifier") == [
        ("AAPL", 2700.0, "EUR", "ISIN:US0378331005"), ("CASH EUR", 2000.0, "EUR", "-"),
        ("CASH PLN", 375.0, "EUR", "-"), ("VWCEl_EQ", 2500.0, "EUR", "ISIN:IE00BK5BQT80"),
    ]
    assert dict(rows(got, "ticker", "description"))["VWCEl_EQ"] == "-"


def test_portfolio_golden(spark):
    df = spark.createDataFrame([("AAPL", 2700.0), ("VWCE", 5000.0), ("CASH PLN", 375.0)], "ticker string, target_value double")
    fill = {c: F.lit("x") for c in ("broker", "security_ccy", "target_ccy", "position_type", "identifier", "description")}
    got = H.portfolio_holdings(df.withColumns(fill).withColumn("security_value", F.col("target_value")))
    assert dict(rows(got, "ticker", "percentage")) == {"AAPL": 33.4365, "VWCE": 61.9195, "CASH PLN": 4.644}


def test_portfolio_of_nothing_is_zero_percent(spark):
    df = spark.createDataFrame([("A", 5.0), ("B", -5.0)], "ticker string, target_value double")
    whole = df.agg(F.sum("target_value")).scalar()
    assert rows(df.select(H.percentage_of(F.col("target_value"), whole))) == [(0.0,), (0.0,)]


def test_aggregate_percentages_golden(spark):
    held = spark.createDataFrame(
        [
            ("B", "VWCE", 100.0, "EUR", "", "", "EQUITY"), ("B", "VWCE", 62.5, "USD", "", "", "EQUITY"),
            ("B", "AAPL", 125.0, "EUR", "ISIN:1", "Apple", "EQUITY"), ("B", "CASH PLN", 100.0, "PLN", "", "", "CASH"),
            ("B", "GONE", 7.0, "EUR", "", "", "EQUITY"), ("B", "GONE", -7.0, "EUR", "", "", "EQUITY"),
        ],
        HELD,
    )
    got = H.aggregate_percentages(held, X.rates_frame(spark, {"USD": 0.8, "PLN": 0.25})).collect()
    assert [(r.ticker, round(r.percentage, 4), r.identifier) for r in got] == [
        ("VWCE", 50.0, "-"), ("AAPL", 41.6667, "ISIN:1"), ("CASH PLN", 8.3333, "-"),
    ]


def test_zero_net_worth_fails(spark):
    held = spark.createDataFrame(
        [("B", "UP", 5.0, "EUR", "", "", "EQUITY"), ("B", "DOWN", -5.0, "EUR", "", "", "EQUITY")], HELD
    )
    with pytest.raises(Exception, match="net worth is zero"):
        H.aggregate_percentages(held, X.rates_frame(spark)).collect()


def test_identifier_by_broker(spark):
    snap = spark.createDataFrame([(" SXR8.DE ", 1.0, "PLN", " IE1 ", "d", "EQUITY"), ("CASH", 1.0, "PLN", "", None, "CASH")],
                                 "label string, security_value double, security_ccy string, isin string, description string, position_type string")
    assert rows(H.extract_holdings(snap, "xtb"), "broker", "ticker", "identifier") == [("XTB", "CASH", "TICKER:CASH"), ("XTB", "SXR8.DE", "TICKER:SXR8.DE")]
    assert rows(H.extract_holdings(snap, "trading212"), "broker", "identifier") == [("Trading 212", ""), ("Trading 212", "ISIN:IE1")]
