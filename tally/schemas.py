"""Declared table schemas, enumerations and required-field registry."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "ts": T.TimestampType(),
    "str": T.StringType(),
    "bin": T.BinaryType(),
    "dbl": T.DoubleType(),
    "long": T.LongType(),
}


def _table(spec: str) -> T.StructType:
    fields = (item.strip().split(":") for item in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# --- fixed values: layers, enumerations, broker names ---
LAYERS = ("raw", "normalized", "analytics")
EVENT_TYPES = (
    "TRADE", "DIVIDEND", "DEPOSIT", "WITHDRAWAL", "FEE",
    "TAX", "INTEREST", "TRANSFER", "ADJUSTMENT", "UNKNOWN",
)
POSITION_TYPES = ("EQUITY", "CASH")
PASS, FAIL, WARN = "PASS", "FAIL", "WARN"
BROKER_NAMES = {"ibkr": "IBKR", "trading212": "Trading 212", "xtb": "XTB"}
DEFAULT_TARGET = "EUR"

# --- table schemas; "bin" columns hold encrypted payloads or money ---
RAW = _table("fetched_at:ts, broker:str, source:str, payload:bin, payload_hash:str, source_file:str")

SNAPSHOT = _table(
    "fetched_at:ts, account_id:str, position_type:str, label:str, asset_class:str,"
    "security_value:bin, security_ccy:str, isin:str, description:str"
)

EVENTS = _table(
    "fetched_at:ts, broker:str, account_id:str, event_id:str, source:str, event_type:str,"
    "raw_event_type:str, event_datetime:str, security_ccy:str, instrument_ccy:str,"
    "cash_amount:bin, settle_date:str, ticker:str, isin:str, description:str, quantity:bin,"
    "price:bin, side:str, fee_amount:bin, tax_amount:bin, target_fx_rate:bin,"
    "target_value:bin, target_ccy:str"
)

CONSOLIDATED_HOLDINGS = _table(
    "fetched_at:ts, broker:str, ticker:str, security_value:bin, security_ccy:str,"
    "target_value:bin, target_ccy:str, identifier:str, description:str, position_type:str"
)

PORTFOLIO_HOLDINGS = _table(
    "calculated_at:ts, broker:str, ticker:str, security_ccy:str, security_value:bin,"
    "target_value:bin, target_ccy:str, percentage:dbl, position_type:str, identifier:str,"
    "description:str"
)

DATA_QUALITY = _table(
    "checked_at:ts, table_name:str, check_name:str, status:str, details:str, threshold:str, actual:str"
)

DIVIDEND_INCOME = _table(
    "calculated_at:ts, period_month:str, period_quarter:str, broker:str, ticker:str, isin:str,"
    "description:str, security_ccy:str, instrument_ccy:str, cash_amount:bin, target_value:bin,"
    "target_ccy:str, event_count:long"
)

INTEREST_INCOME = _table(
    "calculated_at:ts, period_month:str, period_quarter:str, broker:str, security_ccy:str,"
    "cash_amount:bin, target_value:bin, target_ccy:str, event_count:long"
)

CASH_FLOW_SUMMARY = _table(
    "calculated_at:ts, period_month:str, period_quarter:str, broker:str, event_type:str,"
    "security_ccy:str, cash_amount:bin, target_value:bin, target_ccy:str, event_count:long"
)

# --- money columns of each schema ---
SNAPSHOT_MONEY = ("security_value",)
EVENTS_MONEY = (
    "cash_amount", "quantity", "price", "fee_amount", "tax_amount", "target_fx_rate", "target_value",
)
HOLDINGS_MONEY = ("security_value", "target_value")
INCOME_MONEY = ("cash_amount", "target_value")


def plain(schema: T.StructType) -> T.StructType:
    """The same table with its encrypted money columns opened to doubles."""
    return T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.BinaryType) else f.dataType, True)
            for f in schema.fields
        ]
    )


# --- registries used by the quality checks ---
_EVENT_REQUIRED = ("fetched_at", "broker", "event_id", "event_type", "cash_amount")
_SNAPSHOT_REQUIRED = ("fetched_at", "account_id", "security_ccy", "security_value")
_INCOME_REQUIRED = ("calculated_at", "period_month", "broker", "security_ccy", "cash_amount", "event_count")


class TableSpec:
    """What the quality checks need to know about one table."""

    def __init__(self, layer: str, schema: T.StructType, required: tuple[str, ...]):
        self.layer = layer
        self.schema = schema
        self.required = required
        self.freshness = "fetched_at" if layer == "normalized" else "calculated_at"


CHECKED_TABLES: dict[str, TableSpec] = {
    "consolidated_holdings": TableSpec(
        "normalized", CONSOLIDATED_HOLDINGS, ("fetched_at", "broker", "ticker", "target_ccy", "target_value")
    ),
    "events": TableSpec("normalized", EVENTS, _EVENT_REQUIRED),
    **{f"{b}_snapshot": TableSpec("normalized", SNAPSHOT, _SNAPSHOT_REQUIRED) for b in BROKER_NAMES},
    **{f"{b}_events": TableSpec("normalized", EVENTS, _EVENT_REQUIRED) for b in BROKER_NAMES},
    "portfolio_holdings": TableSpec(
        "analytics",
        PORTFOLIO_HOLDINGS,
        (
            "calculated_at", "broker", "ticker", "percentage", "security_ccy",
            "security_value", "target_value", "target_ccy", "position_type",
        ),
    ),
    "dividend_income": TableSpec("analytics", DIVIDEND_INCOME, _INCOME_REQUIRED),
    "interest_income": TableSpec("analytics", INTEREST_INCOME, _INCOME_REQUIRED),
    "cash_flow_summary": TableSpec("analytics", CASH_FLOW_SUMMARY, _INCOME_REQUIRED + ("event_type",)),
}
