from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators import quality as Q
from tally.operators.shaping import conform, empty
from tally.schemas import CHECKED_TABLES, EVENTS, FAIL, PASS, WARN

from .conftest import NOW, rows


def test_schema_check():
    assert Q.schema_check(EVENTS, EVENTS).status == PASS
    fewer = T.StructType(EVENTS.fields[1:])
    assert Q.schema_check(fewer, EVENTS).details == "missing field: fetched_at"
    assert Q.schema_check(EVENTS, fewer).details == "extra field: fetched_at"
    retyped = T.StructType([T.StructField("fetched_at", T.StringType()), *EVENTS.fields[1:]])
    assert "expected timestamp, got string" in Q.schema_check(retyped, EVENTS).details
    moved = T.StructType([*EVENTS.fields[1:], EVENTS.fields[0]])
    check = Q.schema_check(moved, EVENTS)
    assert (check.status, check.details) == (FAIL, "columns out of order")
    strict = T.StructType([T.StructField(f.name, f.dataType, False) for f in EVENTS.fields])
    assert Q.schema_check(strict, EVENTS).status == PASS


@pytest.mark.parametrize("rows_, previous, status", [(10, None, PASS), (50, 100, PASS), (49, 100, WARN), (0, 0, PASS), (200, 100, PASS)])
def test_row_count(rows_, previous, status):
    assert Q.row_count_check(rows_, previous).status == status


def test_freshness():
    def check(rows_, newest, present=True):
        return Q.freshness_check("t", "fetched_at", rows_, newest, 7, NOW, present).status

    assert check(1, NOW - timedelta(days=6)) == PASS
    assert check(1, NOW - timedelta(days=8)) == WARN
    assert check(1, datetime(2026, 8, 3)) == PASS
    assert check(0, None) == PASS
    assert check(3, None) == WARN
    assert check(3, None, present=False) == WARN


def table(spark, name, **values):
    spec = CHECKED_TABLES[name]
    defaults = {f.name: F.lit("x") if isinstance(f.dataType, T.StringType) else F.lit(None) for f in spec.schema.fields}
    defaults |= {f.name: F.lit(b"t") for f in spec.schema.fields if isinstance(f.dataType, T.BinaryType)}
    defaults |= {"fetched_at": F.lit(NOW), **values}
    return conform(spark.range(4).withColumns(defaults), spec.schema)


def statuses(checks):
    return {c.name: c.status for c in checks}


def test_all_checks_of_a_table(spark):
    good = Q.table_checks("events", table(spark, "events"), previous=4, now=NOW, must_have_rows=True)
    assert set(statuses(good).values()) == {PASS} and len(good) == 5
    bad = Q.table_checks(
        "events", table(spark, "events", cash_amount=F.when(F.col("id") > 1, F.lit(b"t")), fetched_at=F.lit(datetime(2026, 1, 1, tzinfo=UTC))),
        previous=100, now=NOW,
    )
    assert statuses(bad) == {"schema": PASS, "required_nulls": FAIL, "row_count_stability": WARN, "freshness": WARN}
    assert "cash_amount: 2 nulls" in next(c for c in bad if c.name == "required_nulls").details
    cut = Q.table_checks("events", table(spark, "events").drop("broker", "fetched_at"), previous=None, now=NOW)
    assert statuses(cut) == {"schema": FAIL, "required_nulls": PASS, "row_count_stability": PASS, "freshness": WARN}
    none = Q.table_checks("events", empty(spark, EVENTS), previous=None, now=NOW, must_have_rows=True)
    assert statuses(none)["non_empty"] == WARN and statuses(none)["freshness"] == PASS


def test_reconciliation(spark):
    held = spark.createDataFrame([("IBKR", "EUR"), ("XTB", "EUR")], "broker string, target_ccy string")

    def check(events):
        df = None if events is None else spark.createDataFrame(events, "broker string, security_ccy string")
        return Q.reconciliation_check(held, df)

    assert check([("IBKR", "EUR"), ("XTB", "USD")]).status == PASS
    assert check([("IBKR", "USD")]).actual == "missing: ['XTB']"
    assert check([("IBKR", "USD"), ("XTB", "USD")]).actual == "uncovered: ['EUR']"
    assert check(None).status == WARN and check([]).status == WARN


def test_history(spark):
    at = [NOW, NOW + timedelta(hours=1), NOW + timedelta(hours=2)]
    data = [
        (at[0], "events", "row_count_stability", PASS, "", None, "100"), (at[1], "events", "row_count_stability", WARN, "", None, "40"),
        (at[2], "events", "row_count_stability", FAIL, "", None, "1"), (at[2], "events", "schema", PASS, "", None, "7"),
        (at[0], "other", "row_count_stability", PASS, "", None, "many"),
    ]
    history = Q.results_frame(spark, [], NOW).unionByName(spark.createDataFrame(data, Q.DATA_QUALITY))
    assert dict(rows(Q.previous_counts(history))) == {"events": 40, "other": None}
    assert Q.latest_run(history).count() == 2


def test_table_selection():
    assert Q.select_tables(["events", "xtb_events", "nope"], ["ibkr"]) == ["events", "nope"]
    assert len(Q.select_tables(None, None)) == 12
    assert "ibkr_events" in Q.select_tables(None, ["ibkr"]) and "xtb_events" not in Q.select_tables(None, ["ibkr"])


def test_exit_code():
    ok, warn, fail = (Q.Check("c", s, "") for s in (PASS, WARN, FAIL))
    assert [Q.exit_code([ok]), Q.exit_code([ok, warn]), Q.exit_code([ok, warn], True), Q.exit_code([fail])] == [0, 0, 1, 1]
