import json

import pytest
from pyspark.sql import Observation

from tally.brokers import trading212 as T
from tally.functions.fernet import encrypt_payload
from tally.schemas import EVENTS, SNAPSHOT, plain
from tally.sources.json_payloads import decode_rows
from tally.sources.landing import IncompleteFetchError, require_sources

from .conftest import KEY, has_schema, rows
from .payloads import DAY1, DAY2, DEPOSIT, DIVIDEND, ORDER, POSITIONS, SUMMARY, page, position, raw, raw_row

B = "Trading 212"


def snap(spark, summary=SUMMARY, positions=POSITIONS, *more):
    entries = [raw_row(B, "/equity/metadata/instruments", "[]")]
    if summary is not None:
        entries.append(raw_row(B, "/equity/account/summary", json.dumps(summary)))
    if positions is not None:
        entries.append(raw_row(B, "/equity/positions", json.dumps(positions)))
    return raw(spark, *entries, *more)


def test_snapshot_golden(spark):
    df = T.snapshot(encrypt_payload(snap(spark), KEY), KEY)
    assert has_schema(df, plain(SNAPSHOT))
    assert rows(df, "label", "security_value", "security_ccy", "asset_class", "account_id", "description") == [
        ("CASH GBP", 240.5, "GBP", "CASH", "", "Cash GBP"),
        ("MERIDd_EQ", 123.75, "EUR", "EQUITY", "", "Meridian"),
        ("PINE_US_EQ", 11.0, "USD", "EQUITY", "", "Pine"),
        ("TARNl_EQ", 30.0, "GBP", "EQUITY", "", "Tarn"),
    ]


def test_snapshot_needs_both_pages(spark):
    assert T.snapshot(snap(spark, None)).count() == 0
    assert T.snapshot(snap(spark, SUMMARY, None)).count() == 0


def test_snapshot_combines_the_latest_of_each_endpoint(spark):
    newer = raw_row(B, "/equity/positions", json.dumps([position("NEW", "n", "i", "USD", 1, 2)]), DAY2)
    got = rows(T.snapshot(snap(spark, SUMMARY, POSITIONS, newer)), "label", "security_value")
    assert got == [("CASH GBP", 240.5), ("NEW", 2.0)]


def test_zero_or_missing_cash_gives_no_row(spark):
    for summary in ({"currency": "PLN", "cash": {"availableToTrade": 0}}, {"currency": "PLN"}, {"cash": {"availableToTrade": "x"}}):
        assert "CASH" not in {r[0] for r in rows(T.snapshot(snap(spark, summary)), "position_type")}
    nameless = rows(T.snapshot(snap(spark, {"cash": {"availableToTrade": 5}}, [])), "label", "security_ccy", "security_value")
    assert nameless == [("CASH", "", 5.0)]


@pytest.mark.parametrize("broken", [{"quantity": None}, {"currentPrice": None}])
def test_position_without_price_or_quantity_fails(spark, broken):
    with pytest.raises(Exception, match="position without price or quantity"):
        T.snapshot(snap(spark, SUMMARY, [POSITIONS[1] | broken])).collect()


def events(spark, *entries):
    return T.events(encrypt_payload(raw(spark, *entries), KEY), KEY)


def order(**changes):
    made = json.loads(json.dumps(ORDER))
    for path, value in changes.items():
        *parents, leaf = path.split("__")
        at = made
        for p in parents:
            at = at[p]
        if value is KeyError:
            del at[leaf]
        else:
            at[leaf] = value
    return made


def test_order_golden(spark):
    df = events(spark, raw_row(B, "/equity/history/orders", page([ORDER])))
    assert has_schema(df, plain(EVENTS))
    r = df.first()
    assert (r.event_id, r.event_type, r.side, r.quantity, r.price, r.cash_amount, r.security_ccy) == ("90210", "TRADE", "BUY", 8.0, 43.0, -344.0, "USD")
    assert (r.event_datetime, r.settle_date, r.isin, r.fee_amount, r.tax_amount, r.account_id) == ("2025-02-11T08:05:00Z", "2025-02-11T08:05:02Z", "XX0000000002", 0.0, 0.0, "")


def test_order_fallbacks_sign_and_fx(spark):
    made = order(
        order__side="SELL", fill__walletImpact__fxRate=0.25, fill__walletImpact__netValue=KeyError, fill__quantity=KeyError,
        order__ticker=KeyError, order__createdAt=KeyError, order__instrument__currency=KeyError,
        fill__walletImpact__taxes=[
            {"name": "STAMP_DUTY", "quantity": -4}, {"name": "PTM_LEVY", "quantity": 1}, {"name": "FRENCH_TRANSACTION_TAX", "quantity": -2.0},
            {"name": "OTHER", "quantity": 99}, {"name": "FINRA_FEE"},
        ],
    )
    r = events(spark, raw_row(B, "/equity/history/orders?cursor=2", page([made], True))).first()
    assert (r.cash_amount, r.fee_amount, r.tax_amount) == (86.0, 1.25, 0.5)
    assert (r.quantity, r.ticker, r.event_datetime, r.security_ccy) == (8.0, "NORDX_US_EQ", "2025-02-11T08:05:02Z", "USD")
    assert r.source == "/equity/history/orders?cursor=2"


def test_order_without_fill_or_side(spark):
    made = order(order__side=KeyError)
    del made["fill"]
    r = events(spark, raw_row(B, "/equity/history/orders", page([made]))).first()
    assert (r.cash_amount, r.price, r.settle_date, r.fee_amount) == (344.0, None, "2025-02-11T08:05:00Z", 0.0)


def test_dividends_and_transactions(spark):
    odd = DIVIDEND | {"reference": "dv-6", "type": "ORDINARY", "currency": None, "grossAmountPerShare": None}
    df = events(
        spark,
        raw_row(B, "/equity/history/dividends", page([DIVIDEND, odd], True)),
        raw_row(B, "/equity/history/transactions", page([DEPOSIT, DEPOSIT | {"reference": "tx-4", "type": "WITHDRAW", "amount": -1.0}, DEPOSIT | {"reference": "tx-5", "type": "GIFT"}])),
    )
    got = rows(df, "event_id", "event_type", "raw_event_type", "cash_amount", "security_ccy", "instrument_ccy", "price")
    assert got == [
        ("dv-5", "DIVIDEND", "DIVIDEND", 3.2, "EUR", "USD", 0.4),
        ("dv-6", "DIVIDEND", "ORDINARY", 3.2, "USD", "USD", 0.0),
        ("tx-3", "DEPOSIT", "DEPOSIT", 60.0, "GBP", None, 0.0),
        ("tx-4", "WITHDRAWAL", "WITHDRAW", -1.0, "GBP", None, 0.0),
        ("tx-5", "UNKNOWN", "GIFT", 60.0, "GBP", None, 0.0),
    ]


def test_ids_are_scoped_by_event_type_and_newest_wins(spark):
    same_id = DIVIDEND | {"reference": "90210"}
    later = order(fill__walletImpact__netValue=350.0)
    df = events(
        spark,
        raw_row(B, "/equity/history/orders", page([ORDER]), DAY1),
        raw_row(B, "/equity/history/orders", page([later]), DAY2),
        raw_row(B, "/equity/history/dividends", page([same_id]), DAY1),
    )
    assert rows(df, "event_type", "cash_amount") == [("DIVIDEND", 3.2), ("TRADE", -350.0)]


def test_unreadable_rows_are_dropped_and_counted(spark):
    good = encrypt_payload(
        raw(spark, raw_row(B, "/equity/history/orders", page([ORDER])), raw_row(B, "/equity/history/orders", "{oops"),
            raw_row(B, "/equity/history/orders", '{"other": 1}'), raw_row(B, "/equity/history/orders", "[]")), KEY,
    )
    seen = Observation("decode")
    df = T.events(good.unionByName(raw(spark, raw_row(B, "/equity/history/orders", "not a token"))), KEY, seen)
    assert df.count() == 1
    assert seen.get == {"rows": 5, "decode_failures": 1, "parse_failures": 1, "empty_payloads": 2}


def test_source_is_matched_by_prefix(spark):
    assert events(spark, raw_row(B, "/v2/equity/history/orders", page([ORDER]))).count() == 0


def test_currency_mismatches(spark):
    df = raw(spark, raw_row(B, "/equity/history/dividends", page([DIVIDEND, DIVIDEND | {"currency": "USD"}, DIVIDEND | {"currency": None}])))
    assert rows(T.currency_mismatches(decode_rows(df, None))) == [(1,)]


def test_required_sources(spark):
    full = [raw_row(B, f"/equity/history/{n}?x=1", "[]") for n in ("orders", "dividends", "transactions")]
    assert require_sources(raw(spark, *full)).count() == 3
    with pytest.raises(IncompleteFetchError, match="transactions"):
        require_sources(raw(spark, *full[:2]))
    with pytest.raises(IncompleteFetchError, match="no page"):
        require_sources(raw(spark))
