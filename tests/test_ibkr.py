import pytest

from tally.brokers import ibkr
from tally.functions.fernet import encrypt_payload
from tally.schemas import EVENTS, SNAPSHOT, plain
from tally.sources.xml_statements import conversion_rates

from .conftest import KEY, has_schema, plan_of, rows
from .payloads import ACCOUNT, DAY1, DAY2, element, events_xml, raw, raw_row, snapshot_xml, statement


def one(spark, xml, source="flex_events"):
    return raw(spark, raw_row("IBKR", source, xml))


def test_snapshot_golden(spark):
    df = ibkr.snapshot(encrypt_payload(one(spark, snapshot_xml(), "flex"), KEY), KEY)
    assert has_schema(df, plain(SNAPSHOT))
    assert rows(df, "label", "position_type", "asset_class", "security_value", "security_ccy", "isin", "account_id") == [
        ("CASH EUR", "CASH", "CASH", 615.4, "EUR", "", ACCOUNT),
        ("CASH USD", "CASH", "CASH", -20.0, "USD", "", ACCOUNT),
        ("LARCH", "EQUITY", "STK", -150.0, "EUR", "", ACCOUNT),
        ("MERID", "EQUITY", "FUND", 1200.0, "USD", "XX0000000011", ACCOUNT),
        ("PINE", "EQUITY", "STK", 55.5, "USD", "", ACCOUNT),
        ("TARN", "EQUITY", "WAR", 40.0, "EUR", "", ACCOUNT),
        ("Unlisted", "EQUITY", "STK", 20.0, "EUR", "", ACCOUNT),
    ]


def test_snapshot_takes_the_latest_statement_only(spark):
    df = raw(
        spark,
        raw_row("IBKR", "flex", snapshot_xml("OLD"), DAY1),
        raw_row("IBKR", "flex", snapshot_xml("NEW"), DAY2),
        raw_row("IBKR", "flex_events", events_xml(), DAY2),
    )
    assert {r[0] for r in rows(ibkr.snapshot(df), "account_id")} == {"NEW"}


def test_plain_payload_is_read_and_malformed_xml_fails(spark):
    assert ibkr.snapshot(one(spark, snapshot_xml(), "flex"), KEY).count() == 7
    with pytest.raises(Exception):
        ibkr.snapshot(one(spark, "<FlexQueryResponse><a>", "flex"), KEY).collect()


def test_cash_falls_back_to_the_first_summary_row(spark):
    def cash(*items, currency="USD"):
        listed = [element("CashReportCurrency", accountId="U1", currency=c, endingCash=v) for c, v in items]
        return rows(
            ibkr.snapshot(one(spark, statement(("CashReport", listed), account="U1", currency=currency), "flex")),
            "label", "security_value",
        )

    assert cash(("BASE_SUMMARY", "0"), ("BASE_SUMMARY", "7"), ("TOTAL", "9")) == [("CASH USD", 7.0)]
    assert cash(("BASE_SUMMARY", "7"), currency="EUR") == [("CASH EUR", 7.0)]
    assert cash(("BASE_SUMMARY", "7"), currency="BASE") == [("CASH USD", 7.0)]
    assert cash(("BASE_SUMMARY", "7"), ("PLN", "0")) == []
    assert cash(("BASE_SUMMARY", "7"), ("", "5")) == []
    assert cash(("pln", "3"), ("EUR", "4")) == [("CASH EUR", 4.0), ("CASH PLN", 3.0)]


def test_base_currency_override(spark):
    listed = [element("CashReportCurrency", accountId="U1", currency="BASE_SUMMARY", endingCash="7")]
    xml = statement(("CashReport", listed), account="U1", currency="BASE")
    assert rows(ibkr.snapshot(one(spark, xml, "flex"), base_currency="gbp"), "security_ccy") == [("GBP",)]


def test_events_golden(spark):
    df = ibkr.events(encrypt_payload(one(spark, events_xml()), KEY), KEY)
    assert has_schema(df, plain(EVENTS))
    got = rows(df, "event_id", "event_type", "cash_amount", "security_ccy", "event_datetime", "target_fx_rate")
    fee_id = next(r[0] for r in got if r[1] == "FEE")
    assert len(fee_id) == 16
    assert got == sorted(
        [
            (fee_id, "FEE", 4.2, "EUR", "2025-04-05T00:00:00Z", 1.0),
            ("tr-9", "TRANSFER", -120.5, "USD", "2025-03-17T08:15:00Z", 0.8),
            ("ct-2", "DIVIDEND", 18.36, "EUR", "2025-03-21T00:00:00Z", 1.0),
            ("ct-5", "TAX", -2.75, "EUR", "2025-03-21T00:00:00Z", 1.0),
            ("ct-3", "DEPOSIT", 2500.0, "EUR", "2025-04-02T00:00:00Z", 1.0),
            ("bx1", "TRADE", -401.5, "EUR", "2025-03-10T14:45:01Z", 1.0),
            ("sx2", "TRADE", 374.25, "USD", "2025-03-11T10:00:00Z", 0.8),
        ],
        key=repr,
    )
    sale = df.filter("event_id = 'sx2'").first()
    assert (sale.quantity, sale.price, sale.side, sale.fee_amount, sale.settle_date) == (-12.0, 31.25, "SELL", 0.75, "2025-03-13T00:00:00Z")
    assert rows(df.filter("event_id = 'bx1'"), "fee_amount") == [(1.5,)]  # in a third currency: left as it is


def test_broker_rate_only_when_base_is_target(spark):
    df = ibkr.events(one(spark, events_xml()), target="USD")
    assert {r[0] for r in rows(df, "target_fx_rate")} == {None}


def test_newest_version_of_an_event_wins(spark):
    df = raw(
        spark,
        raw_row("IBKR", "flex_events", events_xml(amount="18.36"), DAY1),
        raw_row("IBKR", "flex_events", events_xml(amount="19.00"), DAY2),
    )
    out = ibkr.events(df)
    assert out.count() == 7
    assert rows(out.filter("event_id = 'ct-2'"), "cash_amount") == [(19.0,)]


@pytest.mark.parametrize(
    "commission_ccy, currency, fee, stuck",
    [("EUR", "USD", 2.0, 0), ("GBP", "USD", 1.0, 1), ("", "USD", 1.0, 0), ("USD", "USD", 1.0, 0)],
)
def test_commission_currency(spark, commission_ccy, currency, fee, stuck):
    trade = element("Trade", accountId="U1", currency=currency, fxRateToBase="0.5", ibCommission="-1.0",
                    ibCommissionCurrency=commission_ccy, ibExecID="e", dateTime="20260101")
    df = one(spark, statement(("Trades", [trade]), account="U1"))
    assert rows(ibkr.events(df), "fee_amount", "raw_event_type") == [(fee, "ExTrade")]
    assert rows(ibkr.commission_mismatches(ibkr.event_elements(df))) == [(stuck,)]


def test_cash_type_map(spark):
    from pyspark.sql import functions as F

    kinds = [*ibkr.CASH_TYPES, "Deposits/Withdrawals", "New"]
    df = spark.createDataFrame([(k,) for k in kinds], "k string")
    got = dict(rows(df.select("k", ibkr.classify_cash(F.col("k"), F.lit(-1.0)))))
    assert got == {**ibkr.CASH_TYPES, "Deposits/Withdrawals": "WITHDRAWAL", "New": "UNKNOWN"}


def test_paper_deposits(spark):
    df = ibkr.events(one(spark, events_xml()), is_paper=True)
    deposit = df.filter("description = 'Initial paper account deposit'").first()
    assert (deposit.event_datetime, deposit.settle_date, deposit.cash_amount, deposit.security_ccy, deposit.target_fx_rate) == (
        "2025-03-09T00:00:00Z", "2025-03-09", 1_000_000.0, "EUR", 1.0,
    )
    assert df.count() == 8 and ibkr.events(one(spark, events_xml())).count() == 7


def test_statement_facts_equal_those_of_the_mapped_events(spark):
    unread = element("Trade", accountId="U1", currency="USD", ibExecID="x", dateTime="soon")
    dated = element("TransactionFee", accountId="U1", currency="USD", date="20240229", taxDescription="levy", taxAmount="1")
    for raw in (one(spark, events_xml()), one(spark, statement(("Trades", [unread]), ("TransactionFees", [dated]), account="U1", currency="USD")), one(spark, statement(account="U1", currency="USD"))):
        narrow = spark.range(1).select(ibkr.statement_facts(raw, None).alias("f")).select("f.*")
        whole = spark.range(1).select(ibkr.event_facts(ibkr.map_elements(ibkr.event_elements(raw))).alias("f")).select("f.*")
        assert rows(narrow) == rows(whole)


def test_one_full_parse_with_paper_deposits(spark):
    plan = ibkr.events(one(spark, events_xml()), is_paper=True)._jdf.queryExecution().executedPlan().toString()
    parses = plan.split("from_xml(")[1:]
    assert len(parses) == 3 and sum("StructField(_ibCommission," in p for p in parses) == 1


def test_paper_deposit_without_events_or_accounts(spark):
    quiet = ibkr.events(one(spark, statement(account="U1", currency="BASE")), is_paper=True).collect()
    assert [(r.account_id, r.security_ccy, r.event_datetime, r.target_fx_rate) for r in quiet] == [("U1", "USD", "2020-01-01T00:00:00Z", None)]
    assert ibkr.events(one(spark, statement(account="U1", currency=None)), is_paper=True).count() == 0
    trade = element("Trade", accountId="U1", currency="USD", ibExecID="e", dateTime="20260102")
    lost = ibkr.events(one(spark, statement(("Trades", [trade]), account="U1", currency=None)), is_paper=True)
    assert rows(lost.filter("event_type = 'DEPOSIT'"), "account_id", "security_ccy") == [("", "USD")]


def test_accounts_are_per_payload_and_real_codes_win(spark):
    accounts = (
        "<AccountInformation>" + element("AccountInformation", accountId="U1", currency="BASE")
        + element("AccountInformation", accountId="U1", currency="pln") + element("AccountInformation", accountId="U1", currency="")
        + "</AccountInformation>"
    )
    trade = element("Trade", accountId="U1", currency="USD", ibExecID="e", dateTime="20260102")
    xml = statement(("Trades", [trade]), account="U1", currency=None).replace('<FlexStatement accountId="U1">', '<FlexStatement accountId="U1">' + accounts)
    assert rows(ibkr.event_elements(one(spark, xml)), "base_ccy") == [("PLN",)]
    unknown = statement(("Trades", [trade]), account="U1", currency=None)
    assert rows(ibkr.event_elements(one(spark, unknown)), "base_ccy") == [("USD",)]


def test_conversion_rates(spark):
    listed = [element("ConversionRate", fromCurrency=c, rate=r) for c, r in (("USD", "0.9"), ("usd", "0.8"), ("GBP", "0"), ("", "1"), ("PLN", "x"))]
    df = one(spark, statement(("ConversionRates", listed)), "flex")
    assert rows(conversion_rates(df, "flex", None), "ccy", "rate") == [("USD", 0.8)]
