import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tally.brokers import BROKERS
from tally.functions.fernet import decrypt_columns
from tally.operators.income import MissingTargetError
from tally.plans import jobs as J
from tally.plans.report import NothingToReport, portfolio_report
from tally.schemas import CHECKED_TABLES, EVENTS_MONEY, HOLDINGS_MONEY, INCOME_MONEY
from tally.sources.lake import Lake
from tally.streaming.arrivals import ingest_arrivals

from .conftest import KEY, NOW, has_schema, rows
from .payloads import (
    DAY1, DAY2, DEPOSIT, DIVIDEND, ORDER, POSITIONS, SUMMARY, events_xml, page, raw, raw_row, report, snapshot_xml,
)

XLSX = "PLN_70077007_2006-01-01_2026-08-03.xlsx"
RATES = {"USD": 0.9, "PLN": 0.25, "GBP": 1.2}


@pytest.fixture
def ledger(spark, tmp_path):
    return J.Ledger(Lake(spark, str(tmp_path / "lake")), KEY, rates=RATES)


def ibkr(spark, at=DAY2):
    return {
        "snapshot": [raw(spark, raw_row("IBKR", "flex", snapshot_xml(), at))],
        "events": [raw(spark, raw_row("IBKR", "flex_events", events_xml(), at))],
    }


def trading212(spark, at=DAY2, orders=(ORDER,)):
    b = "Trading 212"
    return {
        "snapshot": [raw(spark, raw_row(b, "/equity/account/summary", json.dumps(SUMMARY), at), raw_row(b, "/equity/positions", json.dumps(POSITIONS), at))],
        "events": [
            raw(spark, raw_row(b, "/equity/history/orders", page(list(orders)), at), raw_row(b, "/equity/history/dividends", page([DIVIDEND]), at),
                raw_row(b, "/equity/history/transactions", page([DEPOSIT]), at))
        ],
    }


def xtb(spark, at=DAY2):
    return {"snapshot": [raw(spark, raw_row("XTB", "XTB_REPORT", report(), at, XLSX))]}


def run_all(ledger, spark):
    assert J.run_broker(ledger, "ibkr", ibkr(spark), now=NOW) == 0
    assert J.run_broker(ledger, "trading212", trading212(spark), now=NOW) == 0
    assert J.run_broker(ledger, "xtb", xtb(spark), now=NOW) == 0


def test_ingest_appends_new_content_once_and_returns_the_whole_batch(spark, ledger):
    batch = raw(spark, raw_row("IBKR", "flex", "a", DAY1), raw_row("IBKR", "flex", "b", DAY1))
    again = raw(spark, raw_row("IBKR", "flex", "a", DAY2), raw_row("IBKR", "flex", "c", DAY2))
    J.ingest_raw(ledger, batch, "ibkr")
    handed = J.ingest_raw(ledger, again, "ibkr")
    stored = ledger.lake.read("raw", "ibkr")
    assert stored.count() == 3 and handed.count() == 2
    assert b"gAAAA" == bytes(stored.first().payload)[:5]
    token = {r.payload_hash: bytes(r.payload) for r in stored.collect()}
    assert all(token[r.payload_hash] == bytes(r.payload) for r in handed.collect() if r.payload_hash == rows(raw(spark, raw_row("IBKR", "flex", "c")), "payload_hash")[0][0])
    J.ingest_raw(ledger, again, "ibkr")
    assert ledger.lake.read("raw", "ibkr").count() == 3


def test_empty_first_batch_creates_the_table(spark, ledger):
    J.ingest_raw(ledger, raw(spark), "ibkr")
    assert ledger.lake.read("raw", "ibkr").count() == 0


def test_no_batch_is_a_skip(spark, ledger):
    assert J.run_broker(ledger, "xtb", {"snapshot": []}) == 0
    assert ledger.lake.tables() == []


def test_end_to_end(spark, ledger):
    run_all(ledger, spark)
    assert J.run_consolidation(ledger, ["ibkr", "trading212", "xtb"], now=NOW) == 0

    for name, spec in CHECKED_TABLES.items():
        assert has_schema(ledger.lake.read(spec.layer, name), spec.schema), name

    held = decrypt_columns(ledger.lake.read("normalized", "consolidated_holdings"), HOLDINGS_MONEY, KEY)
    assert [(t, round(v, 6), i) for t, v, i in rows(held.filter("broker = 'IBKR'"), "ticker", "target_value", "identifier")] == [
        ("CASH EUR", 615.4, "-"), ("CASH USD", -18.0, "-"), ("LARCH", -150.0, "-"), ("MERID", 1080.0, "ISIN:XX0000000011"),
        ("PINE", 49.95, "-"), ("TARN", 40.0, "-"), ("Unlisted", 20.0, "-"),
    ]
    assert [t for t, in rows(held.filter("broker = 'XTB'"), "identifier")] == ["TICKER:CASH PLN", "TICKER:CBL.DE", "TICKER:FJD.DE"]

    events = decrypt_columns(ledger.lake.read("normalized", "events"), EVENTS_MONEY, KEY)
    assert events.count() == 7 + 3 + 6
    converted = {r.event_id: round(r.target_value, 6) for r in events.collect()}
    assert (converted["sx2"], converted["90210"], converted["dv-5"], converted["tx-3"], converted["23"]) == (299.4, -309.6, 3.2, 72.0, 225.0)
    assert {r[0] for r in rows(events, "target_ccy")} == {"EUR"}

    portfolio = ledger.lake.read("analytics", "portfolio_holdings")
    assert abs(sum(r[0] for r in rows(portfolio, "percentage")) - 100) < 0.01
    dividends = decrypt_columns(ledger.lake.read("analytics", "dividend_income"), INCOME_MONEY, KEY)
    assert rows(dividends, "period_month", "broker", "target_value", "event_count") == [
        ("2025-02", "Trading 212", 3.2, 1), ("2025-03", "IBKR", 18.36, 1),
    ]

    sets = portfolio_report(ledger.lake, KEY)
    assert {r[0] for r in rows(sets["allocation_by_broker"], "broker")} == {"IBKR", "Trading 212", "XTB"}
    assert dict(rows(sets["sections"])) == {"portfolio": True, "passive_income": True, "cash_flow": True}
    assert dict(rows(sets["passive_income_totals"], "series", "total"))["Dividends"] == pytest.approx(21.56)
    for name, df in sets.items():
        assert df.collect() is not None, name

    ledger.lake.register_views()
    query = "SELECT broker, count(*) AS n FROM events_normalized GROUP BY broker"
    assert rows(ledger.lake.sql(query)) == [("IBKR", 7), ("Trading 212", 3), ("XTB", 6)]


def test_second_run_replaces_and_keeps_quality_history(spark, ledger):
    run_all(ledger, spark)
    assert J.run_consolidation(ledger, now=NOW) == 0
    before = ledger.lake.read("normalized", "events").count()
    later = NOW + timedelta(hours=1)
    assert J.run_broker(ledger, "ibkr", ibkr(spark), now=later) == 0
    assert J.run_consolidation(ledger, now=later) == 0
    assert ledger.lake.read("normalized", "events").count() == before
    J.normalize_events(ledger)
    again = decrypt_columns(ledger.lake.read("normalized", "events"), EVENTS_MONEY, KEY)
    assert again.count() == before and again.filter("target_value IS NULL").count() == 0
    history = J.quality_history(ledger)
    details = rows(history.filter("table_name = 'events' AND check_name = 'row_count_stability'"), "details")
    assert ("row count 16 (previous 16)",) in details


def test_current_batch_brokers_do_not_read_history(spark, ledger):
    J.run_broker(ledger, "trading212", trading212(spark, DAY1), now=NOW)
    other = json.loads(json.dumps(ORDER)) | {}
    other["order"]["id"] = 777
    J.run_broker(ledger, "trading212", trading212(spark, DAY2, [other]), now=NOW)
    events = ledger.lake.read("normalized", "trading212_events")
    assert rows(events.filter("event_type = 'TRADE'"), "event_id") == [("777",)]
    snapshot = ledger.lake.read("normalized", "trading212_snapshot")
    assert snapshot.count() == 4  # three positions that are held, and cash: unchanged pages still reach the transform
    J.transform_broker(ledger, BROKERS["trading212"])
    assert ledger.lake.read("normalized", "trading212_events").filter("event_type = 'TRADE'").count() == 2


def test_missing_rate_stops_before_any_write(spark, ledger):
    ledger.target, ledger.rates = "CHF", {"EUR": 1.0, "USD": 0.9}
    J.run_broker(ledger, "ibkr", ibkr(spark), now=NOW)
    assert J.run_consolidation(ledger, now=NOW) == 0
    before = rows(ledger.lake.read("normalized", "events"), "event_id", "target_ccy")
    ledger.rates = {"USD": 0.9}
    with pytest.raises(Exception, match="no rate to CHF"):
        J.consolidate_ledger(ledger)
    assert rows(ledger.lake.read("normalized", "events"), "event_id", "target_ccy") == before


def test_no_holdings(ledger):
    assert J.run_consolidation(ledger, now=NOW) == 1
    with pytest.raises(NothingToReport):
        portfolio_report(ledger.lake, KEY)


def test_analytics_builders_run_independently(spark, ledger):
    run_all(ledger, spark)
    J.consolidate(ledger, NOW)
    assert J.run_analytics(ledger, NOW) == 1
    assert ledger.lake.exists("analytics", "portfolio_holdings") and not ledger.lake.exists("analytics", "dividend_income")


def test_holdings_without_any_events(spark, ledger):
    snapshot = {"snapshot": [raw(spark, raw_row("XTB", "XTB_REPORT", report(without=("Cash Operations",)), DAY1, XLSX))]}
    assert J.run_broker(ledger, "xtb", snapshot, now=NOW) == 0
    for name in ("xtb_events",):
        assert ledger.lake.read("normalized", name).count() == 0
    assert J.run_consolidation(ledger, now=NOW) == 0
    assert ledger.lake.read("normalized", "events").count() == 0
    assert ledger.lake.read("analytics", "cash_flow_summary").count() == 0
    note = J.quality_history(ledger).filter("check_name = 'reconciliation'").first()
    assert note.status == "WARN" and "no events" in note.details


def test_no_event_table_at_all(spark, ledger):
    J.consolidate_ledger(ledger)
    assert ledger.lake.read("normalized", "events").count() == 0
    J.income_rollup(ledger)


def test_unconverted_events_fail_the_rollup_even_without_a_readable_time(spark, ledger):
    run = {"snapshot": [], "events": [raw(spark, raw_row("IBKR", "flex_events", events_xml(), DAY2))]}
    J.run_broker(ledger, "ibkr", run, now=NOW)
    J.consolidate_ledger(ledger)
    stored = ledger.lake.read("normalized", "events")
    broken = stored.withColumns({"event_datetime": F.lit("soon"), "target_ccy": F.lit(None).cast("string")})
    ledger.lake.overwrite(broken, "normalized", "events")
    with pytest.raises(MissingTargetError, match="7 event"):
        J.income_rollup(ledger)


def test_validation_of_absent_and_unknown_tables(ledger):
    assert J.validate(ledger, ["events", "nope"], now=NOW) == 0
    assert J.validate(ledger, ["events"], fail_on_warn=True, now=NOW + timedelta(hours=1)) == 1
    assert rows(J.quality_history(ledger).filter("check_name = 'table_present'"), "status").count(("WARN",)) == 3


def test_broken_table_fails_validation(spark, ledger):
    J.run_broker(ledger, "ibkr", ibkr(spark), now=NOW)
    broken = ledger.lake.read("normalized", "ibkr_events").withColumn("event_id", F.lit(None).cast("string"))
    ledger.lake.overwrite(broken, "normalized", "ibkr_events")
    assert J.validate(ledger, ["ibkr_events"], ["ibkr"], now=NOW) == 1


def test_arrivals_are_ingested_once(spark, ledger, tmp_path):
    box = tmp_path / "box"
    box.mkdir()
    (box / XLSX).write_bytes(report())
    check = str(tmp_path / "checkpoint")
    ingest_arrivals(ledger, str(box), check)
    assert ledger.lake.read("raw", "xtb").count() == 1
    assert ledger.lake.read("normalized", "xtb_events").count() == 6
    ingest_arrivals(ledger, str(box), check)
    assert ledger.lake.read("raw", "xtb").count() == 1
    (box / "PLN_222_a.xlsx").write_bytes(report(account="222"))
    (box / "PLN_333_copy.xlsx").write_bytes(report())
    ingest_arrivals(ledger, str(box), check)
    assert ledger.lake.read("raw", "xtb").count() == 2
    assert rows(ledger.lake.read("normalized", "xtb_events").select("account_id").distinct()) == [("222",), ("70077007",)]
    ingest_arrivals(ledger, str(box), str(tmp_path / "other"))  # a replay adds nothing
    assert ledger.lake.read("raw", "xtb").count() == 2
