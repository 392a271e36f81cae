"""Trading 212: JSON responses to snapshot rows and events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.brokers.base import Broker
from tally.functions.fernet import Key
from tally.functions.values import lookup, safe_float, text_or_empty
from tally.operators.dedup import TRADING212_EVENT_KEY, dedup_newest, latest_per_source
from tally.operators.shaping import conform, row_struct
from tally.schemas import BROKER_NAMES, EVENTS, SNAPSHOT, plain
from tally.sources.json_payloads import decode_rows, explode_events, unwrap
from tally.sources.landing import (
    DIVIDENDS_PATH, EVENT_PATHS, ORDERS_PATH, POSITIONS_PATH, SUMMARY_PATH, TRANSACTIONS_PATH,
)

# --- fixed values: transaction types, names of fee and tax entries ---
TRANSACTION_TYPES = {
    "WITHDRAW": "WITHDRAWAL",
    "DEPOSIT": "DEPOSIT",
    "FEE": "FEE",
    "TRANSFER": "TRANSFER",
}
FEE_NAMES = (
    "CURRENCY_CONVERSION_FEE",
    "FINRA_FEE",
    "PTM_LEVY",
    "STAMP_DUTY",
    "STAMP_DUTY_RESERVE_TAX",
    "TRANSACTION_FEE",
)
TAX_NAMES = ("FRENCH_TRANSACTION_TAX",)

# --- payload shapes; numbers that may be absent or text stay strings ---
_INSTRUMENT = "struct<ticker:string,isin:string,name:string,currency:string>"
SUMMARY_JSON = "struct<currency:string,cash:struct<availableToTrade:string>>"
POSITION_JSON = f"struct<instrument:{_INSTRUMENT},quantity:string,currentPrice:string>"
TAXES_JSON = "array<struct<name:string,quantity:double>>"
ORDER_JSON = (
    "struct<order:struct<id:string,ticker:string,side:string,currency:string,createdAt:string,"
    f"instrument:{_INSTRUMENT},filledQuantity:double,value:double,filledValue:double,quantity:double>,"
    "fill:struct<id:string,quantity:double,price:double,filledAt:string,walletImpact:"
    f"struct<currency:string,fxRate:double,netValue:double,realisedProfitLoss:double,taxes:{TAXES_JSON}>>>"
)
DIVIDEND_JSON = (
    "struct<reference:string,type:string,paidOn:string,currency:string,tickerCurrency:string,"
    f"amount:double,quantity:double,grossAmountPerShare:double,ticker:string,instrument:{_INSTRUMENT}>"
)
TRANSACTION_JSON = "struct<reference:string,type:string,amount:double,currency:string,dateTime:string>"

_NAME = BROKER_NAMES["trading212"]


def is_endpoint(path: str) -> Column:
    """Rows of a request path: a prefix, so that page suffixes match; never a substring."""
    return F.col("source").startswith(path)


# ---------------------------------------------------------------- snapshot


def _holding(position_type: str, label: Column, asset: str, value: Column, ccy: Column, isin: Column, text: Column) -> Column:
    return F.struct(
        F.lit("").alias("account_id"),
        F.lit(position_type).alias("position_type"),
        label.alias("label"),
        F.lit(asset).alias("asset_class"),
        value.alias("security_value"),
        ccy.alias("security_ccy"),
        isin.alias("isin"),
        text.alias("description"),
    )


def position_holding(p: Column) -> Column:
    """Price times quantity in the instrument's currency; a null of either fails the job."""
    broken = F.raise_error(F.concat(F.lit("position without price or quantity: "), text_or_empty(p["instrument"]["ticker"])))
    value = safe_float(p["currentPrice"]) * safe_float(p["quantity"])
    complete = p["currentPrice"].isNotNull() & p["quantity"].isNotNull()
    i = p["instrument"]
    return _holding(
        "EQUITY", i["ticker"], "EQUITY", F.when(complete, value).otherwise(broken.cast("double")),
        i["currency"], i["isin"], i["name"],
    )


def cash_holding(summary: Column) -> Column:
    ccy = text_or_empty(summary["currency"])
    amount = safe_float(summary["cash"]["availableToTrade"])
    return _holding(
        "CASH", F.rtrim(F.concat(F.lit("CASH "), ccy)), "CASH", amount, ccy, F.lit(""),
        F.rtrim(F.concat(F.lit("Cash "), ccy)),
    )


def snapshot(raw: DataFrame, key: Key | None = None) -> DataFrame:
    """Positions and cash of the latest account summary and positions page.

    Both pages are picked in one aggregate that keeps a single payload each per
    task; without either of them there is no snapshot.
    """
    wanted = raw.filter(is_endpoint(SUMMARY_PATH) | is_endpoint(POSITIONS_PATH))
    rows = decode_rows(latest_per_source(wanted), key)

    def newest(path: str) -> Column:
        age = F.when(is_endpoint(path) & F.col("text").isNotNull(), F.struct("fetched_at", "source", "payload_hash"))
        return F.max_by("text", age)

    pair = rows.agg(
        newest(SUMMARY_PATH).alias("summary"),
        newest(POSITIONS_PATH).alias("positions"),
        F.max(F.when(F.col("text").isNotNull(), F.col("fetched_at"))).alias("fetched_at"),
    ).filter(F.col("summary").isNotNull() & F.col("positions").isNotNull())
    is_list = F.ltrim("positions").startswith("[")
    listed = F.when(is_list, unwrap("positions", POSITION_JSON))
    typed = pair.select(
        "fetched_at", F.from_json("summary", SUMMARY_JSON).alias("summary"), listed.alias("positions")
    )
    equity = F.transform("positions", position_holding)
    cash = F.array(cash_holding(F.col("summary")))
    every = F.concat(F.coalesce(equity, F.slice(cash, 1, 0)), cash)
    held = typed.select("fetched_at", F.inline(every)).filter(F.col("security_value") != 0)
    return conform(held, plain(SNAPSHOT))


# ---------------------------------------------------------------- events


def tax_sum(taxes: Column, names: tuple[str, ...]) -> Column:
    """Sum of absolute amounts of the entries with one of the names; 0 without any."""
    chosen = F.filter(taxes, lambda t: t["name"].isin(*names))
    summed = F.aggregate(
        chosen, F.lit(0.0), lambda total, t: total + F.abs(F.coalesce(t["quantity"], F.lit(0.0)))
    )
    return F.coalesce(summed, F.lit(0.0))


def order_fields(item: Column) -> dict[str, Column]:
    order, fill = item["order"], item["fill"]
    instrument, wallet = order["instrument"], fill["walletImpact"]
    rate = F.coalesce(wallet["fxRate"], F.lit(1.0))
    net = F.coalesce(wallet["netValue"], order["filledValue"])
    direction = F.when(order["side"] == "BUY", F.lit(-1.0)).otherwise(F.lit(1.0))
    return {
        "event_id": order["id"],
        "event_type": F.lit("TRADE"),
        "raw_event_type": F.lit("ORDER"),
        "event_datetime": F.coalesce(order["createdAt"], fill["filledAt"]),
        "security_ccy": F.coalesce(instrument["currency"], order["currency"]),
        "cash_amount": net * rate * direction,
        "settle_date": F.coalesce(fill["filledAt"], order["createdAt"]),
        "ticker": F.coalesce(order["ticker"], instrument["ticker"]),
        "isin": instrument["isin"],
        "description": instrument["name"],
        "quantity": F.coalesce(fill["quantity"], order["filledQuantity"]),
        "price": fill["price"],
        "side": order["side"],
        "fee_amount": tax_sum(wallet["taxes"], FEE_NAMES) * rate,
        "tax_amount": tax_sum(wallet["taxes"], TAX_NAMES) * rate,
    }


def dividend_fields(d: Column) -> dict[str, Column]:
    return {
        "event_id": d["reference"],
        "event_type": F.lit("DIVIDEND"),
        "raw_event_type": F.coalesce(d["type"], F.lit("DIVIDEND")),
        "event_datetime": d["paidOn"],
        "security_ccy": F.coalesce(d["currency"], d["tickerCurrency"]),
        "instrument_ccy": d["tickerCurrency"],
        "cash_amount": d["amount"],
        "settle_date": d["paidOn"],
        "ticker": F.coalesce(d["ticker"], d["instrument"]["ticker"]),
        "isin": d["instrument"]["isin"],
        "description": d["instrument"]["name"],
        "quantity": d["quantity"],
        "price": F.coalesce(d["grossAmountPerShare"], F.lit(0.0)),
        "side": F.lit(""),
        "fee_amount": F.lit(0.0),
        "tax_amount": F.lit(0.0),
    }


def transaction_fields(t: Column) -> dict[str, Column]:
    blank = {n: F.lit("") for n in ("settle_date", "ticker", "isin", "description", "side")}
    zero = {n: F.lit(0.0) for n in ("quantity", "price", "fee_amount", "tax_amount")}
    return {
        "event_id": t["reference"],
        "event_type": lookup(TRANSACTION_TYPES, t["type"], "UNKNOWN"),
        "raw_event_type": t["type"],
        "event_datetime": t["dateTime"],
        "security_ccy": t["currency"],
        "cash_amount": t["amount"],
        **blank,
        **zero,
    }


_ENDPOINTS = {
    ORDERS_PATH: (ORDER_JSON, order_fields),
    DIVIDENDS_PATH: (DIVIDEND_JSON, dividend_fields),
    TRANSACTIONS_PATH: (TRANSACTION_JSON, transaction_fields),
}


# what the payload says about an event; the rest comes from its raw row
_FROM_PAYLOAD = T.StructType(
    [f for f in plain(EVENTS).fields if f.name not in ("fetched_at", "broker", "account_id", "source")]
)


def _mapped(elements: Column, fields: Callable[[Column], dict[str, Column]]) -> Column:
    return F.transform(elements, lambda item: row_struct(fields(item), _FROM_PAYLOAD))


def page_events(rows: DataFrame) -> DataFrame:
    """Events of decoded pages of all endpoints, in one pass over the rows.

    Each page is parsed with its endpoint's element type only.
    """
    found = F.lit(None)
    for path, (element, fields) in _ENDPOINTS.items():
        found = F.when(is_endpoint(path), _mapped(unwrap("text", element), fields)).otherwise(found)
    exploded = rows.select("fetched_at", "source", F.inline(found))
    return conform(
        exploded.withColumns({"broker": F.lit(_NAME), "account_id": F.lit("")}), plain(EVENTS)
    )


def currency_mismatches(rows: DataFrame) -> DataFrame:
    """One row: dividends paid in another currency than the instrument trades in."""
    item = F.col("item")
    differs = (
        (text_or_empty(item["currency"]) != "")
        & (text_or_empty(item["tickerCurrency"]) != "")
        & (item["currency"] != item["tickerCurrency"])
    )
    exploded = explode_events(rows.filter(is_endpoint(DIVIDENDS_PATH)), DIVIDEND_JSON)
    return exploded.agg(F.count_if(differs).alias("mismatches"))


def events(raw: DataFrame, key: Key | None = None, observation: Observation | None = None) -> DataFrame:
    """Events of all history pages, newest version per (event type, event id)."""
    wanted = raw.filter(is_endpoint(ORDERS_PATH) | is_endpoint(DIVIDENDS_PATH) | is_endpoint(TRANSACTIONS_PATH))
    rows = decode_rows(wanted, key, observation=observation)
    return dedup_newest(page_events(rows), TRADING212_EVENT_KEY)


BROKER = Broker("trading212", snapshot, events, uses_current_batch=True, event_sources=EVENT_PATHS)
