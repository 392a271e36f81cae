import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tally.functions import values as V

from .conftest import rows


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def outputs(spark, values, expression, kind="string"):
    df = column(spark, values, kind).coalesce(1)
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_safe_float(spark):
    assert outputs(spark, ["1.5", "", None, "abc", "1e3", " 2 "], V.safe_float) == [1.5, 0.0, 0.0, 0.0, 1000.0, 2.0]
    assert outputs(spark, ["", "x", "0.5"], lambda c: V.safe_float(c, 1.0)) == [1.0, 1.0, 0.5]


def test_european_float(spark):
    given = ["1 234,50", "1 234,5", "1,234.5", "12", "", None, "n/a", "-0,25"]
    assert outputs(spark, given, V.european_float) == [1234.5, 1234.5, 0.0, 12.0, 0.0, 0.0, 0.0, -0.25]


def test_round_exact_equals_python_round(spark):
    rng = random.Random(7)
    given = [rng.randrange(-10**7, 10**7) / 1000 for _ in range(3000)]
    given += [2.675, 1.005, 1.145, 2.5, 0.125, -0.375, 1e15 + 0.5]
    assert outputs(spark, given, lambda c: V.round_exact(c, 2), "double") == [round(x, 2) + 0.0 for x in given]


def test_round_half_even_has_no_negative_zero(spark):
    got = outputs(spark, [0.00005, 0.12345, -0.00001], lambda c: V.round_half_even(c, 4), "double")
    assert [repr(x) for x in got] == ["0.0", "0.1234", "0.0"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("CASH EUR", "CASH EUR"),
        ("AAPLu_EQ", "AAPL"),
        ("AAPL_US_EQ", "AAPL"),
        ("VWCEl_EQ", "VWCE"),
        ("SXR8_ETF", "SXR8"),
        ("FOO_DE", "FOO"),
        ("foo", "foo"),
        ("VOD_EQ", "VOD"),
    ],
)
def test_normalize_ticker(spark, given, expected):
    assert outputs(spark, [given], V.normalize_ticker) == [expected]


def test_trade_comment(spark):
    df = column(spark, ["OPEN BUY 10.0001 @ 100.00", "CLOSE SELL 2 @ 3", "OPEN HOLD 1 @ 2", "", None]).coalesce(1)
    got = [tuple(r) for r in df.select(*V.trade_comment("x").values()).collect()]
    assert got == [("BUY", 10.0001, 100.0), ("SELL", 2.0, 3.0)] + [(None, None, None)] * 3


def test_file_names(spark):
    given = ["PLN_12345678_2006-01-01_2026-08-03.xlsx", "in/EUR_99_x.xlsx", "report.xlsx", "PLN_12a_x.xlsx"]
    assert outputs(spark, given, V.account_from_file_name) == ["12345678", "99", None, None]
    assert outputs(spark, ["a/b%20c+d.xlsx", "x%zz.xlsx"], V.file_name) == ["b c+d.xlsx", "x%zz.xlsx"]


def test_event_hash(spark):
    import hashlib

    expected = hashlib.sha256(b"Trade|U1|20260101||5").hexdigest()[:16]
    df = spark.createDataFrame([("U1", "20260101", None, "5")], "a string, b string, c string, d string")
    assert df.select(V.event_hash(F.lit("Trade"), "a", "b", "c", "d")).first()[0] == expected


def test_iso_datetime(spark):
    given = ["20260702;022904", "20260204", "2026-03-01 00:00:00", "2026-03-01", "", None]
    expected = ["2026-07-02T02:29:04Z", "2026-02-04T00:00:00Z", "2026-03-01 00:00:00", "2026-03-01", "", None]
    assert outputs(spark, given, V.iso_datetime) == expected


def test_event_time_and_periods(spark):
    given = [
        "20260702;022904", "20260204", "2026-03-01 00:00:00", "2024-01-15", "2024-01-15T10:30:00Z",
        "2024-12-31T23:30:00.1234-0200", "2024-01-15T10:30:00", "2024-13-01", "soon", "", None,
    ]
    df = column(spark, given).coalesce(1).select(V.event_time("x").alias("t"))
    got = [tuple(r) for r in df.select(V.period_month("t"), V.period_quarter("t")).collect()]
    assert got == [
        ("2026-07", "2026-Q3"), ("2026-02", "2026-Q1"), ("2026-03", "2026-Q1"), ("2024-01", "2024-Q1"),
        ("2024-01", "2024-Q1"), ("2025-01", "2025-Q1"),
    ] + [(None, None)] * 5


def test_excel_timestamp(spark):
    got = outputs(spark, ["46236.291666666664", "45000.5", "59", "61", "text", ""], V.excel_timestamp)
    assert got == [
        datetime(2026, 8, 2, 7), datetime(2023, 3, 15, 12), datetime(1900, 2, 28), datetime(1900, 3, 1), None, None,
    ]


def test_iso_offset_text(spark):
    df = spark.sql("SELECT timestamp'2026-08-02 07:00:00' AS a, timestamp'2026-08-02 07:00:00.5' AS b")
    assert rows(df.select(V.iso_offset_text("a"), V.iso_offset_text("b"))) == [
        ("2026-08-02T07:00:00+00:00", "2026-08-02T07:00:00.500000+00:00")
    ]
