"""IBKR: XML statements to snapshot rows and events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.brokers.base import Broker
from tally.functions.fernet import Key
from tally.functions.values import (
    event_hash, first_filled, iso_datetime, lookup, safe_float, text_or_empty, upper_or_empty,
)
from tally.operators.dedup import IBKR_EVENT_KEY, dedup_newest, latest_per_source
from tally.operators.shaping import conform
from tally.schemas import BROKER_NAMES, DEFAULT_TARGET, EVENTS, SNAPSHOT, plain
from tally.sources.landing import FLEX, FLEX_EVENTS
from tally.sources.xml_statements import (
    ACCOUNTS_XML, EVENT_ATTRIBUTES, EVENT_SECTIONS, EVENT_TIMES_XML, EVENTS_XML, SNAPSHOT_XML, TIME_ATTRIBUTES, accounts,
    base_currencies, is_currency_row, items, parse_statements,
)

# --- fixed values: cash transaction types ---
CASH_TYPES = {
    "Dividends": "DIVIDEND",
    "PaymentInLieue": "DIVIDEND",
    "Withholding Tax": "TAX",
    "871(m) Withholding": "TAX",
    "Broker Interest Received": "INTEREST",
    "Broker Interest Paid": "INTEREST",
    "Bond Interest Received": "INTEREST",
    "Bond Interest Paid": "INTEREST",
    "Broker Fees": "FEE",
    "Other Fees": "FEE",
    "Other Income": "ADJUSTMENT",
    "Price Adjustments": "ADJUSTMENT",
    "Commission Adjustments": "FEE",
}
DEPOSITS_WITHDRAWALS = "Deposits/Withdrawals"
PAPER_DEPOSIT = 1_000_000.0

_NAME = BROKER_NAMES["ibkr"]


def classify_cash(kind: Column, amount: Column) -> Column:
    """Event type of a cash transaction; deposits and withdrawals by sign."""
    by_sign = F.when(amount >= 0, F.lit("DEPOSIT")).otherwise(F.lit("WITHDRAWAL"))
    return F.when(kind == DEPOSITS_WITHDRAWALS, by_sign).otherwise(lookup(CASH_TYPES, kind, "UNKNOWN"))


# ---------------------------------------------------------------- snapshot

_HOLDING = (
    "struct<account_id:string,position_type:string,label:string,asset_class:string,"
    "security_value:double,security_ccy:string,isin:string,description:string>"
)


def _holding(**fields: Column) -> Column:
    order = ("account_id", "position_type", "label", "asset_class", "security_value", "security_ccy", "isin", "description")
    return F.struct(*[fields[n].alias(n) for n in order])


def position_holding(p: Column) -> Column:
    """An open position; a zero reported value falls back to quantity times mark price."""
    reported = safe_float(p["_positionValue"])
    fallback = safe_float(p["_position"]) * safe_float(p["_markPrice"])
    label = first_filled(p["_symbol"], p["_description"], F.lit("UNKNOWN"))
    return _holding(
        account_id=text_or_empty(p["_accountId"]),
        position_type=F.lit("EQUITY"),
        label=label,
        asset_class=F.upper(first_filled(p["_assetCategory"], F.lit("STK"))),
        security_value=F.when(reported == 0, fallback).otherwise(reported),
        security_ccy=first_filled(upper_or_empty(p["_currency"]), F.lit("USD")),
        isin=F.upper(F.trim(text_or_empty(p["_isin"]))),
        description=first_filled(p["_description"], p["_symbol"], label),
    )


def cash_holding(account: Column, currency: Column, amount: Column) -> Column:
    code = upper_or_empty(currency)
    return _holding(
        account_id=text_or_empty(account),
        position_type=F.lit("CASH"),
        label=F.concat(F.lit("CASH "), code),
        asset_class=F.lit("CASH"),
        security_value=amount,
        security_ccy=code,
        isin=F.lit(""),
        description=F.concat(F.lit("Cash "), code),
    )


def cash_holdings(rows: Column, bases: Column) -> Column:
    """Cash per currency; without any such row, the first non-zero summary row in base currency."""
    per_currency = F.filter(rows, lambda r: is_currency_row(r["_currency"]))
    listed = F.transform(
        F.filter(per_currency, lambda r: upper_or_empty(r["_currency"]) != ""),
        lambda r: cash_holding(r["_accountId"], r["_currency"], safe_float(r["_endingCash"])),
    )
    summaries = F.filter(
        rows, lambda r: ~is_currency_row(r["_currency"]) & (safe_float(r["_endingCash"]) != 0)
    )
    fallback = F.transform(
        F.slice(summaries, 1, 1),
        lambda r: cash_holding(
            r["_accountId"],
            F.coalesce(F.try_element_at(bases, text_or_empty(r["_accountId"])), F.lit("USD")),
            safe_float(r["_endingCash"]),
        ),
    )
    return F.when(F.size(per_currency) > 0, listed).otherwise(fallback)


def snapshot(raw: DataFrame, key: Key | None = None, base_currency: str | None = None) -> DataFrame:
    """Positions and cash of the latest statement; rows of zero value are dropped."""
    latest = latest_per_source(raw.filter(F.col("source") == FLEX))
    parsed = parse_statements(latest, FLEX, SNAPSHOT_XML, key)
    bases = base_currencies(accounts(), base_currency)
    nothing = F.array().cast(f"array<{_HOLDING}>")
    equity = F.transform(items("OpenPositions", "OpenPosition"), position_holding)
    cash = cash_holdings(items("CashReport", "CashReportCurrency"), bases)
    every = F.concat(F.coalesce(equity, nothing), F.coalesce(cash, nothing))
    rows = parsed.select("fetched_at", F.inline(every)).filter(F.col("security_value") != 0)
    return conform(rows, plain(SNAPSHOT))


# ---------------------------------------------------------------- events


def event_elements(raw: DataFrame, key: Key | None = None) -> DataFrame:
    """One row per event element: ``fetched_at``, its ``kind``, its attributes, its account's base currency.

    All four sections come out of a single parse of the payload, and the base
    currencies of a payload's accounts travel with it, so there is nothing to join.
    """
    parsed = parse_statements(raw, FLEX_EVENTS, EVENTS_XML, key)
    attributes = ",".join(f"_{a}:string" for a in EVENT_ATTRIBUTES)
    nothing = F.array().cast(f"array<struct<kind:string,e:struct<{attributes}>>>")
    sections = [
        F.coalesce(F.transform(items(s, i), _tagged(i)), nothing) for s, i in EVENT_SECTIONS.items()
    ]
    with_bases = parsed.withColumn("bases", base_currencies(accounts()))
    rows = with_bases.select("fetched_at", "bases", F.inline(F.concat(*sections)))
    account = text_or_empty("e._accountId")
    return rows.select(
        "fetched_at",
        "kind",
        "e.*",
        F.coalesce(F.try_element_at("bases", account), upper_or_empty("e._currency")).alias("base_ccy"),
    )


def _tagged(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("e"))


def _attr(name: str) -> Column:
    return text_or_empty(f"_{name}")


def _shared(target: str) -> dict[str, Column]:
    rate = safe_float("_fxRateToBase", 1.0)
    return {
        "broker": F.lit(_NAME),
        "account_id": _attr("accountId"),
        "source": F.col("kind"),
        "security_ccy": upper_or_empty("_currency"),
        "ticker": _attr("symbol"),
        "isin": _attr("isin"),
        "target_fx_rate": F.when(F.col("base_ccy") == target.upper(), rate),
    }


def _hashed(kind: str, *names: str) -> Column:
    return event_hash(F.lit(kind), "_accountId", *[F.col(f"_{n}") for n in names])


def trade_fields() -> dict[str, Column]:
    """Trade: the commission is brought to the trade currency when it is in base currency."""
    fee = F.abs(safe_float("_ibCommission"))
    fee_ccy = upper_or_empty("_ibCommissionCurrency")
    rate = safe_float("_fxRateToBase", 1.0)
    foreign = (fee_ccy != "") & (fee_ccy != upper_or_empty("_currency"))
    in_base = foreign & (fee_ccy == F.col("base_ccy")) & (rate != 0)
    return {
        "event_id": first_filled("_ibExecID", "_tradeID", _hashed("Trade", "dateTime", "symbol", "quantity")),
        "event_type": F.lit("TRADE"),
        "raw_event_type": F.coalesce("_transactionType", F.lit("ExTrade")),
        "event_datetime": iso_datetime(_attr("dateTime")),
        "cash_amount": safe_float("_netCash"),
        "settle_date": iso_datetime(_attr("settleDateTarget")),
        "description": _attr("description"),
        "quantity": safe_float("_quantity"),
        "price": safe_float("_tradePrice"),
        "side": _attr("buySell"),
        "fee_amount": F.when(in_base, F.try_divide(fee, rate)).otherwise(fee),
        "tax_amount": safe_float("_taxes"),
    }


def cash_fields() -> dict[str, Column]:
    amount = safe_float("_amount")
    return {
        "event_id": first_filled("_transactionID", _hashed("CashTransaction", "dateTime", "type", "amount")),
        "event_type": classify_cash(_attr("type"), amount),
        "raw_event_type": _attr("type"),
        "event_datetime": iso_datetime(_attr("dateTime")),
        "cash_amount": amount,
        "settle_date": iso_datetime(_attr("settleDate")),
        "description": _attr("description"),
    }


def transfer_fields() -> dict[str, Column]:
    return {
        "event_id": first_filled("_transactionID", _hashed("Transfer", "dateTime", "symbol", "quantity")),
        "event_type": F.lit("TRANSFER"),
        "raw_event_type": _attr("type"),
        "event_datetime": iso_datetime(_attr("dateTime")),
        "cash_amount": safe_float("_cashTransfer"),
        "settle_date": iso_datetime(_attr("settleDate")),
        "description": _attr("description"),
        "quantity": safe_float("_quantity"),
        "price": safe_float("_transferPrice"),
        "side": _attr("direction"),
    }


def fee_fields() -> dict[str, Column]:
    amount = safe_float("_taxAmount")
    return {
        "event_id": _hashed("TransactionFee", "date", "taxDescription", "taxAmount"),
        "event_type": F.lit("FEE"),
        "raw_event_type": _attr("taxDescription"),
        "event_datetime": iso_datetime(_attr("date")),
        "cash_amount": amount,
        "settle_date": iso_datetime(_attr("settleDate")),
        "description": _attr("taxDescription"),
        "quantity": safe_float("_quantity"),
        "price": safe_float("_tradePrice"),
        "fee_amount": amount,
    }


_FIELDS = {
    "Trade": trade_fields,
    "CashTransaction": cash_fields,
    "Transfer": transfer_fields,
    "TransactionFee": fee_fields,
}


def map_elements(elements: DataFrame, target: str = DEFAULT_TARGET) -> DataFrame:
    """Event elements of all kinds to events, in one projection."""
    by_kind = {kind: fields() for kind, fields in _FIELDS.items()}
    names = {name for fields in by_kind.values() for name in fields}
    mapped = _shared(target)
    for name in names:
        value = F.lit(None)
        for kind, fields in by_kind.items():
            if name in fields:
                value = F.when(F.col("kind") == kind, fields[name]).otherwise(value)
        mapped[name] = value
    return conform(elements.select("fetched_at", *[c.alias(n) for n, c in mapped.items()]), plain(EVENTS))


def commission_mismatches(elements: DataFrame) -> DataFrame:
    """One row: trades whose commission currency could not be converted (fee left as it is)."""
    fee_ccy = upper_or_empty("_ibCommissionCurrency")
    stuck = (fee_ccy != "") & (fee_ccy != upper_or_empty("_currency")) & (
        (fee_ccy != F.col("base_ccy")) | (safe_float("_fxRateToBase", 1.0) == 0)
    )
    return elements.filter(F.col("kind") == "Trade").agg(F.count_if(stuck).alias("unconverted_fees"))


def _moment(text: Column) -> Column:
    """A readable event time, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def event_facts(events: DataFrame) -> Column:
    """Earliest readable event time, earliest fetch and number of events, as one scalar subquery."""
    facts = F.struct(
        F.min(_moment(F.col("event_datetime"))).alias("earliest"), F.min("fetched_at").alias("fetched_at"),
        F.count(F.lit(1)).alias("events"),
    )
    return events.agg(facts.alias("facts")).scalar()


def _time_of(kind: str):
    return lambda e: text_or_empty(e[f"_{TIME_ATTRIBUTES[kind]}"])


def statement_facts(raw: DataFrame, key: Key | None) -> Column:
    """The same of stored statements, read with a schema that has the events' times and nothing else.

    No element becomes a row: each payload's times are folded to their least and their number where they are read.
    """
    parsed = parse_statements(raw, FLEX_EVENTS, EVENT_TIMES_XML, key)
    nothing = F.array().cast("array<string>")
    times = [F.coalesce(F.transform(items(s, i), _time_of(i)), nothing) for s, i in EVENT_SECTIONS.items()]
    found = parsed.select("fetched_at", F.concat(*times).alias("times"))
    folded = found.select("fetched_at", F.array_min(F.transform("times", lambda t: _moment(iso_datetime(t)))).alias("earliest"), F.size("times").cast("long").alias("n"))
    facts = F.struct(
        F.min("earliest").alias("earliest"), F.min(F.when(F.col("n") > 0, F.col("fetched_at"))).alias("fetched_at"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
    )
    return folded.agg(facts.alias("facts")).scalar()


def opening_deposits(events: DataFrame | Column, account_rows: DataFrame, target: str = DEFAULT_TARGET) -> DataFrame:
    """A synthetic opening deposit per account at midnight of the day before the earliest event.

    ``events`` are events, or their facts. ``account_rows`` is ``(account_id,
    base_ccy, fetched_at)``. An account without name (none is known) gets one
    only when there are events.
    """
    known = account_rows.withColumn("facts", event_facts(events) if isinstance(events, DataFrame) else events)
    day = F.coalesce(
        F.date_trunc("day", "facts.earliest") - F.expr("interval 1 day"),
        F.lit(datetime(2020, 1, 1)).cast("timestamp"),
    )
    booked = known.filter((F.col("account_id") != "") | (F.col("facts.events") > 0)).withColumn("day", day)
    deposits = booked.select(
        F.coalesce("facts.fetched_at", "fetched_at").alias("fetched_at"),
        F.lit(_NAME).alias("broker"),
        "account_id",
        event_hash(F.lit("CashTransaction"), "account_id", F.lit("PAPER_INITIAL_DEPOSIT")).alias("event_id"),
        F.lit("CashTransaction").alias("source"),
        F.lit("DEPOSIT").alias("event_type"),
        F.lit(DEPOSITS_WITHDRAWALS).alias("raw_event_type"),
        F.date_format("day", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_datetime"),
        F.col("base_ccy").alias("security_ccy"),
        F.lit(PAPER_DEPOSIT).alias("cash_amount"),
        F.date_format("day", "yyyy-MM-dd").alias("settle_date"),
        F.lit("").alias("ticker"),
        F.lit("").alias("isin"),
        F.lit("Initial paper account deposit").alias("description"),
        F.when(F.upper("base_ccy") == target.upper(), F.lit(1.0)).alias("target_fx_rate"),
    )
    return conform(deposits, plain(EVENTS))


def last_accounts(raw: DataFrame, key: Key | None) -> DataFrame:
    """Accounts and base currencies of the newest events payload.

    Without any account the events are booked on account ``''`` in USD.
    """
    newest = (
        raw.filter(F.col("source") == FLEX_EVENTS)
        .orderBy(F.col("fetched_at").desc(), F.col("payload_hash").desc())
        .limit(1)
    )
    parsed = parse_statements(newest, FLEX_EVENTS, ACCOUNTS_XML, key)
    bases = base_currencies(accounts())
    unknown = F.create_map(F.lit(""), F.lit("USD"))
    return parsed.select(
        F.explode(F.when(F.size(bases) > 0, bases).otherwise(unknown)).alias("account_id", "base_ccy"), "fetched_at"
    )


def events(
    raw: DataFrame, key: Key | None = None, *, target: str = DEFAULT_TARGET, is_paper: bool = False
) -> DataFrame:
    """Events of all statements, newest version per event id."""
    mapped = map_elements(event_elements(raw, key), target)
    if is_paper:
        mapped = mapped.unionByName(opening_deposits(statement_facts(raw, key), last_accounts(raw, key), target))
    return dedup_newest(mapped, IBKR_EVENT_KEY)


BROKER = Broker("ibkr", snapshot, events, needs_target=True)
