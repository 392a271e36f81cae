import random

import pytest

from tally.operators import income as I
from tally.operators import report as R

from .conftest import rows

EVENT = (
    "event_type string, event_datetime string, broker string, ticker string, security_ccy string, "
    "cash_amount double, target_value double, target_ccy string, event_id string, instrument_ccy string, isin string, description string"
)


def event(kind, at, amount, target, *, broker="IBKR", ticker="A", ccy="USD", code="EUR", ident="1", instrument="USD"):
    return (kind, at, broker, ticker, ccy, amount, target, code, ident, instrument, "", "")


def frame(spark, *events):
    return spark.createDataFrame(list(events), EVENT)


def test_dividends(spark):
    df = I.with_periods(
        frame(
            spark,
            event("DIVIDEND", "20260301", 1.5, 1.0, ident="1"), event("DIVIDEND", "2026-03-05", 2.5, 2.0, ident="2"),
            event("DIVIDEND", "2026-03-05", None, None, ticker="B", ident=None, instrument=None),
            event("DIVIDEND", "junk", 9.0, 9.0), event("TRADE", "2026-03-05", 9.0, 9.0),
        )
    )
    assert rows(I.dividend_income(df), "period_month", "period_quarter", "ticker", "cash_amount", "target_value", "event_count", "instrument_ccy") == [
        ("2026-03", "2026-Q1", "A", 4.0, 3.0, 2, "USD"), ("2026-03", "2026-Q1", "B", 0.0, None, 0, None),
    ]


def test_interest_and_cash_flow(spark):
    df = I.with_periods(
        frame(
            spark,
            event("INTEREST", "2026-01-01", 1.0, 0.9), event("INTEREST", "2026-04-01T00:00:00Z", 2.0, 1.8),
            event("INTEREST", "2026-04-02", 3.0, 3.0, ccy=None), event("TRADE", "20260402;101010", -5.0, -4.5),
        )
    )
    assert rows(I.interest_income(df), "period_quarter", "security_ccy", "target_value") == [
        ("2026-Q1", "USD", 0.9), ("2026-Q2", "USD", 1.8), ("2026-Q2", None, 3.0),
    ]
    assert rows(I.cash_flow_summary(df), "event_type", "period_month", "cash_amount") == [
        ("INTEREST", "2026-01", 1.0), ("INTEREST", "2026-04", 2.0), ("INTEREST", "2026-04", 3.0), ("TRADE", "2026-04", -5.0),
    ]


def test_no_events_gives_typed_empty_tables(spark):
    df = I.with_periods(frame(spark))
    for build in (I.dividend_income, I.interest_income, I.cash_flow_summary):
        assert build(df).count() == 0
    assert dict(I.interest_income(df).dtypes)["event_count"] == "bigint"


def test_tables_from_the_shared_base_equal_the_direct_ones(spark):
    rng = random.Random(5)
    data = [
        event(
            rng.choice(["DIVIDEND", "INTEREST", "TRADE"]), rng.choice(["20260101", "2026-02-03", "junk"]),
            rng.choice([None, float(rng.randrange(50))]), rng.choice([None, float(rng.randrange(50))]),
            ticker=rng.choice("AB"), ccy=rng.choice(["USD", None]), code=rng.choice(["EUR", None]),
            ident=rng.choice(["1", None]), instrument=rng.choice(["USD", "GBP", None]),
        )
        for _ in range(400)
    ]
    df = I.with_periods(frame(spark, *data))
    shared = I.income_tables(I.income_base(df))
    for name, build in (("dividend_income", I.dividend_income), ("interest_income", I.interest_income), ("cash_flow_summary", I.cash_flow_summary)):
        direct = build(df)
        assert rows(shared[name], *direct.columns) == rows(direct), name


def test_any_unconverted_event_is_an_error(spark):
    good = event("DIVIDEND", "2026-01-01", 1.0, 1.0)
    assert I.require_target(frame(spark, good)).count() == 1
    with pytest.raises(I.MissingTargetError, match=r"1 event.*\['GBP'\]"):
        I.require_target(frame(spark, good, event("TRADE", "junk", 1.0, None, ccy="GBP")))
    with pytest.raises(I.MissingTargetError):
        I.require_target(frame(spark, event("TRADE", "junk", 1.0, 1.0, code=None, ccy=None)))


HELD = "broker string, ticker string, security_ccy string, target_value double, target_ccy string, percentage double, position_type string"


def held(spark):
    return spark.createDataFrame(
        [
            ("IBKR", "A", "USD", 50.0, "EUR", 50.0, "EQUITY"), ("XTB", "A", "PLN", 25.0, "EUR", 25.0, "EQUITY"),
            ("XTB", "CASH PLN", "PLN", 25.0, "EUR", 25.0, "CASH"),
        ],
        HELD,
    )


def test_allocations(spark):
    df = held(spark)
    assert rows(R.allocation_by_broker(df)) == [("IBKR", 50.0), ("XTB", 50.0)]
    assert [tuple(r) for r in R.largest_first(R.positions(df)).collect()] == [("A", 75.0, "EQUITY"), ("CASH PLN", 25.0, "CASH")]
    assert rows(R.allocation_by_currency(df)) == [("PLN", 50.0), ("USD", 50.0)]
    assert rows(R.currency_allocation(df)) == [("PLN", 50.0, 2), ("USD", 50.0, 1)]
    assert rows(R.cross_broker_tickers(df)) == [("A", 2, 75.0)]
    assert rows(R.summary_by_type(df)) == [("CASH", 25.0, 25.0), ("EQUITY", 75.0, 75.0)]
    assert rows(R.equity_cash_split(df)) == [(75.0, 25.0)]
    assert rows(R.total_value(df)) == [(100.0, "EUR")]


def test_zero_total_gives_zero_shares(spark):
    df = held(spark).selectExpr("* EXCEPT (target_value)", "0.0D AS target_value")
    assert {r[0] for r in rows(R.summary_by_broker(df), "share")} == {0.0}


def flows(spark, data):
    return spark.createDataFrame(data, "event_type string, period_month string, target_value double")


def test_cash_flow_grid_fills_gaps(spark):
    df = flows(spark, [("TRADE", "2026-01", -5.0), ("TRADE", "2026-01", 2.0), ("FEE", "2026-02", 1.0)])
    assert rows(R.cash_flow_grid(df)) == [
        ("FEE", "2026-01", 0.0), ("FEE", "2026-02", 1.0), ("TRADE", "2026-01", -3.0), ("TRADE", "2026-02", 0.0),
    ]
    assert rows(R.cash_flow_peaks(df)) == [("FEE", 1.0), ("TRADE", 3.0)]
    assert R.cash_flow_grid(flows(spark, [])).count() == 0


def outliers(spark, peaks):
    df = spark.createDataFrame([(f"t{i}", float(p)) for i, p in enumerate(peaks)], "event_type string, peak double")
    got = {r.event_type: r.is_outlier for r in R.cash_flow_outliers(df).collect()}
    return [got[f"t{i}"] for i in range(len(peaks))]


@pytest.mark.parametrize(
    "peaks, expected",
    [
        ([1_000_000, 272_000, 1_300], [True, True, False]),
        ([1_000_000, 10_000, 1_000, 1], [True, False, False, False]),
        ([100, 200, 300], [False] * 3),
        ([1_000_000, 900_000], [False] * 2),
        ([5], [False]),
        ([0, 0], [False] * 2),
        ([0, 7], [False] * 2),
        ([1, 1, 1000], [False, False, True]),
    ],
)
def test_outliers(spark, peaks, expected):
    assert outliers(spark, peaks) == expected


def test_outliers_against_the_definition(spark):
    rng = random.Random(11)
    for _ in range(6):
        peaks = [rng.choice([0, 1, 5, 5, 90, 1000, 12_345, 10**6]) for _ in range(rng.randrange(2, 8))]
        expected = []
        for i, p in enumerate(peaks):
            others = [q for j, q in enumerate(peaks) if j != i and q > 0]
            expected.append(bool(others) and p > 10 * max(min(others), max(peaks) / 100))
        assert outliers(spark, peaks) == expected, peaks


def test_passive_income(spark):
    data = spark.createDataFrame([("2026-01", 1.0, "EUR"), ("2026-01", 2.0, "EUR"), ("2026-02", 4.0, "EUR")], "period_month string, target_value double, target_ccy string")
    none = data.limit(0)
    assert rows(R.passive_income(data, none)) == [("2026-01", "Dividends", 3.0), ("2026-02", "Dividends", 4.0)]
    assert rows(R.passive_income_totals(data, none)) == [("Dividends", 7.0, "EUR"), ("Interest", None, None)]


def test_sections(spark):
    counts = spark.createDataFrame(
        [("portfolio_holdings", 3), ("dividend_income", 0), ("interest_income", 2), ("cash_flow_summary", 0)], "table_name string, rows long"
    )
    quality = spark.createDataFrame([("portfolio_holdings", "FAIL"), ("interest_income", "WARN"), ("events", "FAIL")], "table_name string, status string")
    assert dict(rows(R.section_visibility(counts, quality))) == {"portfolio": False, "passive_income": True, "cash_flow": False}


def test_display_order_of_the_income_tables(spark):
    from tally.operators.income import DISPLAY_ORDER, for_display

    df = spark.createDataFrame([("2024-02", "A", "x"), ("2024-01", "B", "y"), ("2024-01", "A", "z"), ("2024-01", "A", "a")], "period_month string, broker string, ticker string")
    assert [tuple(r) for r in for_display(df, "dividend_income").collect()] == [("2024-01", "A", "a"), ("2024-01", "A", "z"), ("2024-01", "B", "y"), ("2024-02", "A", "x")]
    assert set(DISPLAY_ORDER) == {"dividend_income", "interest_income", "cash_flow_summary"}
