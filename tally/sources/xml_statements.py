"""XML statements: one parse per payload, elements as rows.

Data sits in attributes, which the reader exposes as ``_name`` fields. Sections
are arrays so that a repeated section is read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.fernet import Key, decrypt_payload
from tally.functions.values import safe_float, upper_or_empty

# --- fixed values: attributes read from each kind of element ---
ACCOUNT_ATTRIBUTES = ("accountId", "currency")
POSITION_ATTRIBUTES = (
    "accountId", "currency", "assetCategory", "symbol", "description", "isin",
    "position", "markPrice", "positionValue",
)
CASH_REPORT_ATTRIBUTES = ("accountId", "currency", "endingCash")
RATE_ATTRIBUTES = ("fromCurrency", "rate")
EVENT_ATTRIBUTES = (
    "accountId", "symbol", "description", "isin", "currency", "fxRateToBase", "dateTime", "date",
    "settleDateTarget", "settleDate", "quantity", "tradePrice", "transferPrice", "ibCommission",
    "ibCommissionCurrency", "netCash", "amount", "cashTransfer", "taxAmount", "taxes", "buySell",
    "direction", "transactionType", "type", "taxDescription", "ibExecID", "tradeID", "transactionID",
)
EVENT_SECTIONS = {
    "Trades": "Trade",
    "CashTransactions": "CashTransaction",
    "Transfers": "Transfer",
    "TransactionFees": "TransactionFee",
}


def _attributes(names: Sequence[str]) -> str:
    return ",".join(f"_{n}:string" for n in names)


def _section(section: str, item: str, names: Sequence[str]) -> str:
    return f"{section}:array<struct<{item}:array<struct<{_attributes(names)}>>>>"


_ACCOUNTS = (
    "AccountInformation:array<struct<"
    f"{_attributes(ACCOUNT_ATTRIBUTES)},AccountInformation:array<struct<{_attributes(ACCOUNT_ATTRIBUTES)}>>>>"
)


def _statement(*sections: str) -> str:
    return f"FlexStatements struct<FlexStatement:array<struct<{','.join(sections)}>>>"


SNAPSHOT_XML = _statement(
    _ACCOUNTS,
    _section("OpenPositions", "OpenPosition", POSITION_ATTRIBUTES),
    _section("CashReport", "CashReportCurrency", CASH_REPORT_ATTRIBUTES),
)
EVENTS_XML = _statement(
    _ACCOUNTS, *[_section(s, i, EVENT_ATTRIBUTES) for s, i in EVENT_SECTIONS.items()]
)
ACCOUNTS_XML = _statement(_ACCOUNTS)
# The times of events alone; an element's time is in one of two attributes.
TIME_ATTRIBUTES = {i: "date" if i == "TransactionFee" else "dateTime" for i in EVENT_SECTIONS.values()}
EVENT_TIMES_XML = _statement(*[_section(s, i, (TIME_ATTRIBUTES[i],)) for s, i in EVENT_SECTIONS.items()])
RATES_XML = _statement(_section("ConversionRates", "ConversionRate", RATE_ATTRIBUTES))


def parse_statements(raw: DataFrame, source: str, ddl: str, key: Key | None) -> DataFrame:
    """Rows of one ``source`` with their parsed ``statements`` array.

    A payload the key does not open is taken as plain XML. Malformed XML fails
    the job.
    """
    rows = raw.filter(F.col("source") == source)
    if key is not None:
        opened = decrypt_payload(rows.withColumn("__plain", F.col("payload")), key, "__plain")
        rows = opened.withColumn("payload", F.coalesce("__plain", "payload")).drop("__plain")
    parsed = F.from_xml(F.col("payload").cast("string"), ddl, {"mode": "FAILFAST"})
    return rows.select(
        "fetched_at", "payload_hash", parsed["FlexStatements"]["FlexStatement"].alias("statements")
    )


def _present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def items(section: str, item: str, statements: str = "statements") -> Column:
    """All elements of a section, over every statement of the payload."""
    sections = F.flatten(_present(F.transform(F.col(statements), lambda s: s[section])))
    return F.flatten(_present(F.transform(sections, lambda s: s[item])))


def accounts(statements: str = "statements") -> Column:
    """Account elements with an account id; the enclosing section element has none."""
    outer = F.flatten(_present(F.transform(F.col(statements), lambda s: s["AccountInformation"])))
    pairs = F.transform(
        outer,
        lambda a: F.concat(
            F.array(F.struct(a["_accountId"].alias("id"), a["_currency"].alias("ccy"))),
            F.coalesce(
                F.transform(
                    a["AccountInformation"],
                    lambda b: F.struct(b["_accountId"].alias("id"), b["_currency"].alias("ccy")),
                ),
                F.array().cast("array<struct<id:string,ccy:string>>"),
            ),
        ),
    )
    return F.coalesce(
        F.filter(F.flatten(pairs), lambda a: F.coalesce(a["id"], F.lit("")) != ""),
        F.array().cast("array<struct<id:string,ccy:string>>"),
    )


def base_currencies(account_list: Column, override: str | None = None) -> Column:
    """Map account id to base currency.

    The last real code of an account counts; ``BASE`` or nothing at all means USD.
    """
    ids = F.array_distinct(F.transform(account_list, lambda a: a["id"]))

    def base(account: Column) -> Column:
        if override:
            return F.lit(override.upper())
        codes = F.transform(
            F.filter(account_list, lambda a: a["id"] == account), lambda a: upper_or_empty(a["ccy"])
        )
        real = F.filter(codes, lambda c: (c != "") & (c != "BASE"))
        return F.coalesce(F.try_element_at(real, F.lit(-1)), F.lit("USD"))

    return F.map_from_entries(F.transform(ids, lambda i: F.struct(i, base(i))))


def is_currency_row(currency: Column) -> Column:
    """A per-currency cash row: a three-letter code, or nothing."""
    code = upper_or_empty(currency)
    return (code == "") | code.rlike("^[A-Z]{3}$")


def conversion_rates(raw: DataFrame, source: str, key: Key | None) -> DataFrame:
    """``(payload_hash, ccy, rate)`` rows; empty codes and zero rates are dropped.

    A code given twice in a payload keeps its last rate.
    """
    parsed = parse_statements(raw, source, RATES_XML, key)
    rows = parsed.select("fetched_at", "payload_hash", F.posexplode(items("ConversionRates", "ConversionRate")).alias("pos", "e"))
    rated = rows.select(
        "payload_hash", "pos", upper_or_empty("e._fromCurrency").alias("ccy"), safe_float("e._rate").alias("rate")
    ).filter((F.col("ccy") != "") & (F.col("rate") != 0))
    return rated.groupBy("payload_hash", "ccy").agg(F.max_by("rate", "pos").alias("rate"))
