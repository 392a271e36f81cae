"""Ledger-shaped views over the star-schema tables, in Spark and in plain SQL.

The tables hold no broker data, so the registered queries read them through
these views: events become ledger events, line items become holdings, orders
become XML and JSON payloads, customers become workbooks. Each view has a SQL
twin for the comparison engine.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.currency import normalize_currency, rates_frame
from tally.operators.holdings import consolidate_holdings, portfolio_holdings
from tally.operators.income import with_periods
from tally.plans.jobs import Ledger
from tally.sources.lake import Lake
from tally.sources.scratch import Scratch, shared_folder

TARGET = "EUR"
DEMO_KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="
RATES = {"USD": Decimal("0.9"), "GBP": Decimal("1.15"), "PLN": Decimal("0.25")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_ledger(spark: SparkSession, name: str) -> Ledger:
    """A ledger over an empty lake in the shared folder."""
    return Ledger(Lake(spark, f"{shared_folder(spark)}/lakes/{name}-{uuid.uuid4().hex}"), DEMO_KEY, target=TARGET, manual_rates=RATES)


def rates(spark: SparkSession) -> DataFrame:
    return rates_frame(spark, manual=RATES)


RATES_SQL = """rates(ccy, rate) AS (
  VALUES ('USD', CAST(0.9 AS DECIMAL(18,10))), ('GBP', CAST(1.15 AS DECIMAL(18,10))),
         ('PLN', CAST(0.25 AS DECIMAL(18,10))), ('GBX', CAST(0.0115 AS DECIMAL(18,10))))"""

# ---------------------------------------------------------------- ledger


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a ledger event; amounts are exact decimals."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "ts AS fetched_at",
        "CASE event_id % 3 WHEN 0 THEN 'IBKR' WHEN 1 THEN 'Trading 212' ELSE 'XTB' END AS broker",
        "concat('A', user_id % 7) AS account_id",
        "CAST(event_id AS STRING) AS event_id",
        "'events' AS source",
        """CASE event_type WHEN 'purchase' THEN 'TRADE' WHEN 'view' THEN 'DIVIDEND' WHEN 'click' THEN 'INTEREST'
             WHEN 'signup' THEN 'DEPOSIT' WHEN 'error' THEN 'FEE' ELSE 'UNKNOWN' END AS event_type""",
        "event_type AS raw_event_type",
        """CASE event_id % 5
             WHEN 0 THEN date_format(ts, "yyyyMMdd';'HHmmss")
             WHEN 1 THEN date_format(ts, 'yyyyMMdd')
             WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
             WHEN 3 THEN date_format(ts, 'yyyy-MM-dd')
             ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") END AS event_datetime""",
        "CASE user_id % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBX' ELSE 'PLN' END AS security_ccy",
        "CASE user_id % 2 WHEN 0 THEN 'USD' ELSE 'EUR' END AS instrument_ccy",
        """CAST(value AS DECIMAL(18,4))
             * CAST(CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END AS DECIMAL(1,0)) AS cash_amount""",
        "concat('T', user_id % 20) AS ticker",
        "concat('ISIN', user_id % 20) AS isin",
        "concat('Ticker ', user_id % 20) AS description",
        "CASE WHEN event_id % 11 = 0 THEN CAST(0.95 AS DECIMAL(18,10)) END AS target_fx_rate",
    )
    return rows.selectExpr("* EXCEPT (cash_amount)", "CAST(cash_amount AS DECIMAL(18,4)) AS cash_amount")


LEDGER_SQL = """ledger AS (
  SELECT ts AS fetched_at,
    CASE event_id % 3 WHEN 0 THEN 'IBKR' WHEN 1 THEN 'Trading 212' ELSE 'XTB' END AS broker,
    'A' || (user_id % 7) AS account_id, CAST(event_id AS VARCHAR) AS event_id,
    CASE event_type WHEN 'purchase' THEN 'TRADE' WHEN 'view' THEN 'DIVIDEND' WHEN 'click' THEN 'INTEREST'
      WHEN 'signup' THEN 'DEPOSIT' WHEN 'error' THEN 'FEE' ELSE 'UNKNOWN' END AS event_type,
    event_type AS raw_event_type,
    CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y%m%d;%H%M%S') WHEN 1 THEN strftime(ts, '%Y%m%d')
      WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d')
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_datetime,
    CASE user_id % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBX' ELSE 'PLN' END AS security_ccy,
    CASE user_id % 2 WHEN 0 THEN 'USD' ELSE 'EUR' END AS instrument_ccy,
    CAST(CAST(value AS DECIMAL(18,4)) * CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END
      AS DECIMAL(18,4)) AS cash_amount,
    'T' || (user_id % 20) AS ticker, 'ISIN' || (user_id % 20) AS isin, 'Ticker ' || (user_id % 20) AS description,
    CASE WHEN event_id % 11 = 0 THEN CAST(0.95 AS DECIMAL(18,10)) END AS target_fx_rate,
    strftime(ts, '%Y-%m') AS period_month,
    CAST(year(ts) AS VARCHAR) || '-Q' || CAST(quarter(ts) AS VARCHAR) AS period_quarter
  FROM events)"""


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger plus a later, corrected version of every tenth event."""
    rows = ledger(spark, sf_dir)
    again = rows.filter("CAST(event_id AS BIGINT) % 10 = 0").withColumns(
        {
            "fetched_at": F.expr("fetched_at + INTERVAL 1 DAY"),
            "cash_amount": F.expr("CAST(cash_amount + 1 AS DECIMAL(18,4))"),
        }
    )
    return rows.unionByName(again)


REPLAYED_SQL = (
    LEDGER_SQL
    + """, replayed AS (
  SELECT * FROM ledger
  UNION ALL
  SELECT * REPLACE (fetched_at + INTERVAL 1 DAY AS fetched_at, CAST(cash_amount + 1 AS DECIMAL(18,4)) AS cash_amount)
  FROM ledger WHERE CAST(event_id AS BIGINT) % 10 = 0)"""
)


def converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger in the target currency, with periods."""
    return with_periods(normalize_currency(ledger(spark, sf_dir), rates(spark), TARGET, check=False))


_CONVERT = """
    CASE WHEN e.security_ccy = 'EUR' THEN CAST(1 AS DECIMAL(18,10))
      WHEN e.target_fx_rate <> 0 THEN e.target_fx_rate ELSE r.rate END AS fx_rate"""


def convert_sql(source: str) -> str:
    return f"""{RATES_SQL}, converted AS (
  SELECT e.*, e.cash_amount * e.fx_rate AS target_value, 'EUR' AS target_ccy
  FROM (SELECT e.*, {_CONVERT} FROM {source} e LEFT JOIN rates r ON upper(e.security_ccy) = r.ccy) e)"""


CONVERTED_SQL = LEDGER_SQL + ", " + convert_sql("ledger")

# ---------------------------------------------------------------- holdings


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as equity holdings, customer balances as cash holdings."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    ccy = "CASE n_nationkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBX' ELSE 'PLN' END AS security_ccy"
    equity = (
        item.join(part, item.l_partkey == part.p_partkey)
        .join(supplier, item.l_suppkey == supplier.s_suppkey)
        .join(place, supplier.s_nationkey == place.n_nationkey)
        .selectExpr(
            "r_name AS broker",
            "p_brand AS ticker",
            "CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(1 - CAST(l_discount AS DECIMAL(9,4)) AS DECIMAL(9,4))"
            " AS DECIMAL(18,4)) AS security_value",
            ccy,
            "CASE WHEN l_partkey % 3 = 0 THEN '' ELSE concat('ISIN:', p_brand) END AS identifier",
            "p_type AS description",
            "'EQUITY' AS position_type",
        )
    )
    cash = customer.join(place, customer.c_nationkey == place.n_nationkey).selectExpr(
        "r_name AS broker",
        "concat('CASH ', n_name) AS ticker",
        "CAST(c_acctbal AS DECIMAL(18,4)) AS security_value",
        ccy,
        "'' AS identifier",
        "concat('Cash ', n_name) AS description",
        "'CASH' AS position_type",
    )
    return equity.unionByName(cash)


_CCY_SQL = "CASE n_nationkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBX' ELSE 'PLN' END AS security_ccy"
HOLDINGS_SQL = f"""{RATES_SQL}, held AS (
  SELECT r_name AS broker, p_brand AS ticker,
    CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(1 - CAST(l_discount AS DECIMAL(9,4)) AS DECIMAL(9,4))
      AS DECIMAL(18,4)) AS security_value, {_CCY_SQL},
    CASE WHEN l_partkey % 3 = 0 THEN '' ELSE 'ISIN:' || p_brand END AS identifier,
    p_type AS description, 'EQUITY' AS position_type
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT r_name, 'CASH ' || n_name, CAST(c_acctbal AS DECIMAL(18,4)), {_CCY_SQL}, '', 'Cash ' || n_name, 'CASH'
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), consolidated AS (
  SELECT h.broker, h.ticker, h.security_value, h.security_ccy,
    CAST(h.security_value AS DECIMAL(20,4))
      * CASE WHEN h.security_ccy = 'EUR' THEN CAST(1 AS DECIMAL(18,10)) ELSE r.rate END AS target_value,
    'EUR' AS target_ccy, coalesce(nullif(h.identifier, ''), '-') AS identifier, h.description, h.position_type
  FROM held h LEFT JOIN rates r ON h.security_ccy = r.ccy
), whole AS (SELECT CAST(sum(target_value) AS DOUBLE) AS t FROM consolidated
), gold AS (
  SELECT c.*, CAST(round_even(CAST(target_value AS DOUBLE) / t * 100.0 * 10000.0, 0) / 10000.0 AS DECIMAL(18,4))
    AS percentage FROM consolidated c, whole)"""


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return consolidate_holdings(holdings(spark, sf_dir), rates(spark), TARGET, stamp)


def gold_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portfolio holdings; percentages as decimals so that sums do not depend on row order."""
    shares = portfolio_holdings(consolidated(spark, sf_dir))
    return shares.withColumn("percentage", F.col("percentage").cast("decimal(18,4)"))


# ---------------------------------------------------------------- payload rows


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of the test tables, which come in one row group, over as many tasks as the session has shuffle partitions."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def raw_from(rows: DataFrame, broker: str, source: str, text: str, fetched: str = "TIMESTAMP'2024-01-01 00:00:00'") -> DataFrame:
    """Plain (not encrypted) raw rows whose payload is the expression ``text``."""
    made = dealt(rows).selectExpr(
        f"{fetched} AS fetched_at", f"'{broker}' AS broker", f"{source} AS source", f"CAST({text} AS BINARY) AS payload"
    )
    return made.withColumns({"payload_hash": F.sha2("payload", 256), "source_file": F.lit("")})


def _attr(name: str, expression: str) -> str:
    return f"' {name}=\"', {expression}, '\"'"


def statement(account: str, base: str, section: str, element: str, attributes: dict[str, str]) -> str:
    """SQL for one XML statement with a single element per row."""
    attrs = ", ".join(_attr(n, e) for n, e in {"accountId": account, **attributes}.items())
    return (
        "concat('<FlexQueryResponse><FlexStatements count=\"1\"><FlexStatement accountId=\"', "
        f"{account}, '\"><AccountInformation><AccountInformation accountId=\"', {account}, '\" currency=\"', {base}, "
        f"'\"/></AccountInformation><{section}><{element}', {attrs}, '/></{section}>"
        "</FlexStatement></FlexStatements></FlexQueryResponse>')"
    )


# expressions over one order, the same text in both dialects where it can be
ACCOUNT = "concat('U', o_custkey % 50)"
BASE = "CASE WHEN o_custkey % 2 = 0 THEN 'EUR' ELSE 'BASE' END"
CURRENCY = "CASE o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'gbp' ELSE 'PLN' END"
FX_TEXT = "CASE o_orderkey % 3 WHEN 0 THEN '0.9' WHEN 1 THEN '1.25' ELSE '' END"
COMPACT = "date_format(o_orderdate, 'yyyyMMdd')"
COMPACT_TIME = "date_format(o_orderdate, \"yyyyMMdd';'HHmmss\")"

ORDER_SQL = """o AS (
  SELECT *, 'U' || (o_custkey % 50) AS account_id,
    CASE WHEN o_custkey % 2 = 0 THEN 'EUR' ELSE 'USD' END AS base_ccy,
    CASE o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'PLN' END AS ccy,
    CASE o_orderkey % 3 WHEN 0 THEN CAST(0.9 AS DOUBLE) WHEN 1 THEN CAST(1.25 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS fx
  FROM orders)"""


def ibkr_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(
        table(spark, sf_dir, "orders"), "IBKR", "'flex_events'",
        statement(
            ACCOUNT, BASE, "Trades", "Trade",
            {
                "symbol": "o_orderpriority",
                "description": "concat('Order ', o_orderkey)",
                "currency": CURRENCY,
                "fxRateToBase": FX_TEXT,
                "dateTime": COMPACT_TIME,
                "settleDateTarget": COMPACT,
                "quantity": "CAST(o_custkey AS STRING)",
                "tradePrice": "CAST(o_totalprice AS STRING)",
                "netCash": "CAST(-o_totalprice AS STRING)",
                "ibCommission": "CAST(-((o_orderkey % 7) + 0.25D) AS STRING)",
                "ibCommissionCurrency": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'EUR' END",
                "buySell": "CASE WHEN o_orderstatus = 'F' THEN 'SELL' ELSE 'BUY' END",
                "ibExecID": "CASE WHEN o_orderkey % 6 < 3 THEN concat('e', o_orderkey) ELSE '' END",
                "tradeID": "CASE WHEN o_orderkey % 6 = 3 THEN concat('t', o_orderkey) ELSE '' END",
            },
        ),
    )


# --- fixed values: cash transaction types cycled through by order key ---
CASH_TYPE_CYCLE = ("Dividends", "Withholding Tax", "Broker Interest Received", "Other Fees", "Deposits/Withdrawals", "Price Adjustments", "Surprise")
CASH_TYPE = "element_at(array(" + ", ".join(f"'{t}'" for t in CASH_TYPE_CYCLE) + "), CAST(o_orderkey % 7 AS INT) + 1)"
CASH_AMOUNT = "CASE WHEN o_custkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END"


def ibkr_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(
        table(spark, sf_dir, "orders"), "IBKR", "'flex_events'",
        statement(
            ACCOUNT, BASE, "CashTransactions", "CashTransaction",
            {
                "symbol": "o_orderpriority",
                "currency": CURRENCY,
                "fxRateToBase": FX_TEXT,
                "dateTime": COMPACT,
                "settleDate": COMPACT,
                "amount": f"CAST({CASH_AMOUNT} AS STRING)",
                "type": CASH_TYPE,
                "transactionID": "concat('c', o_orderkey)",
            },
        ),
    )


def ibkr_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(
        table(spark, sf_dir, "orders"), "IBKR", "'flex_events'",
        statement(
            ACCOUNT, BASE, "Transfers", "Transfer",
            {
                "symbol": "o_orderpriority",
                "currency": CURRENCY,
                "fxRateToBase": FX_TEXT,
                "dateTime": COMPACT_TIME,
                "settleDate": COMPACT,
                "type": "'ACATS'",
                "direction": "CASE WHEN o_orderstatus = 'F' THEN 'OUT' ELSE 'IN' END",
                "quantity": "CAST(o_custkey AS STRING)",
                "transferPrice": "CAST(o_totalprice AS STRING)",
                "cashTransfer": "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_totalprice AS STRING) ELSE 'n/a' END",
                "transactionID": "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('r', o_orderkey) END",
            },
        ),
    )


def ibkr_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(
        table(spark, sf_dir, "orders"), "IBKR", "'flex_events'",
        statement(
            ACCOUNT, BASE, "TransactionFees", "TransactionFee",
            {
                "symbol": "o_orderpriority",
                "currency": CURRENCY,
                "fxRateToBase": FX_TEXT,
                "date": COMPACT,
                "settleDate": COMPACT,
                "taxDescription": "concat('Fee ', o_orderkey)",
                "taxAmount": "CAST((o_orderkey % 100) / 8.0D AS STRING)",
                "quantity": "CAST(o_custkey AS STRING)",
                "tradePrice": "CAST(o_totalprice AS STRING)",
            },
        ),
    )


def ibkr_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot statement per customer: a position, cash rows, a conversion rate."""
    account = "concat('U', c_custkey)"
    parts = [
        "'<FlexQueryResponse><FlexStatements><FlexStatement accountId=\"'", account,
        "'\"><AccountInformation><AccountInformation accountId=\"'", account,
        "'\" currency=\"'", "CASE WHEN c_custkey % 3 = 0 THEN 'BASE' ELSE 'EUR' END", "'\"/></AccountInformation>'",
        "'<OpenPositions><OpenPosition accountId=\"'", account,
        "'\" currency=\"'", "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'usd' END",
        "'\" symbol=\"'", "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END",
        "'\" description=\"'", "c_name",
        "'\" isin=\" '", "CASE WHEN c_custkey % 2 = 0 THEN 'us0378331005' ELSE '' END",
        "'\" position=\"'", "CAST(c_nationkey AS STRING)", "'\" markPrice=\"2.5\" positionValue=\"'",
        "CASE WHEN c_custkey % 4 = 0 THEN '0.0' ELSE CAST(c_acctbal AS STRING) END", "'\"/></OpenPositions>'",
        "'<CashReport><CashReportCurrency accountId=\"'", account,
        "'\" currency=\"'", "CASE WHEN c_custkey % 3 = 1 THEN 'PLN' ELSE 'BASE_SUMMARY' END",
        "'\" endingCash=\"'", "CAST(c_acctbal AS STRING)",
        "'\"/></CashReport><ConversionRates><ConversionRate fromCurrency=\"usd\" rate=\"'",
        "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE CAST(c_nationkey / 8.0D AS STRING) END",
        "'\"/></ConversionRates></FlexStatement></FlexStatements></FlexQueryResponse>'",
    ]
    return raw_from(table(spark, sf_dir, "customer"), "IBKR", "'flex'", "concat(" + ", ".join(parts) + ")")


def trading212_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One history page per order, as a bare list or wrapped in ``items``."""
    item = """named_struct(
        'order', named_struct('id', o_orderkey, 'ticker', CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END,
          'side', CASE WHEN o_orderstatus = 'F' THEN 'SELL' WHEN o_orderstatus = 'O' THEN 'BUY' END,
          'currency', 'EUR', 'createdAt', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
          'instrument', named_struct('ticker', 'I_EQ', 'isin', concat('X', o_custkey), 'name', 'Name',
            'currency', CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'USD' END),
          'filledQuantity', CAST(o_custkey AS DOUBLE), 'filledValue', o_totalprice),
        'fill', named_struct('id', o_orderkey + 1, 'price', o_totalprice / 4.0D,
          'walletImpact', named_struct('currency', 'PLN',
            'fxRate', CASE WHEN o_orderkey % 2 = 0 THEN 0.25D END,
            'netValue', CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_totalprice / 2.0D END,
            'taxes', array(
              named_struct('name', 'CURRENCY_CONVERSION_FEE', 'quantity', -((o_orderkey % 9) / 4.0D)),
              named_struct('name', 'STAMP_DUTY', 'quantity', (o_orderkey % 5) / 2.0D),
              named_struct('name', 'FRENCH_TRANSACTION_TAX', 'quantity', -(o_custkey / 8.0D)),
              named_struct('name', 'OTHER', 'quantity', 99.0D)))))"""
    page = f"CASE WHEN o_orderkey % 2 = 0 THEN to_json(array({item})) ELSE to_json(named_struct('items', array({item}), 'nextPagePath', 'x')) END"
    return raw_from(table(spark, sf_dir, "orders"), "Trading 212", "'/equity/history/orders?cursor=1'", page)


def trading212_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = """named_struct('reference', concat('d', o_orderkey), 'type', CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'ORDINARY' END,
        'paidOn', date_format(o_orderdate, 'yyyy-MM-dd'), 'currency', CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'EUR' END,
        'tickerCurrency', CASE WHEN o_orderkey % 5 = 0 THEN 'EUR' ELSE 'USD' END, 'amount', o_totalprice,
        'quantity', CAST(o_custkey AS DOUBLE), 'grossAmountPerShare', CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice / 8.0D END,
        'instrument', named_struct('ticker', o_orderpriority, 'isin', concat('X', o_custkey), 'name', 'Name'))"""
    return raw_from(table(spark, sf_dir, "orders"), "Trading 212", "'/equity/history/dividends'", f"to_json(array({item}))")


def trading212_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = """named_struct('reference', concat('x', o_orderkey),
        'type', element_at(array('WITHDRAW', 'DEPOSIT', 'FEE', 'TRANSFER', 'BONUS'), CAST(o_orderkey % 5 AS INT) + 1),
        'amount', CASE WHEN o_orderkey % 5 = 0 THEN -o_totalprice ELSE o_totalprice END, 'currency', 'PLN',
        'dateTime', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"))"""
    return raw_from(
        table(spark, sf_dir, "orders"), "Trading 212", "'/equity/history/transactions'",
        f"to_json(named_struct('items', array({item})))",
    )


# ---------------------------------------------------------------- workbooks


_text = lru_cache(maxsize=4096)(escape)


def _sheet(rows: list[list[object]]) -> str:
    out = []
    for number, cells in enumerate(rows, 1):
        out.append(f'<row r="{number}">')
        for at, value in enumerate(cells):
            if value is None:
                continue
            letter = chr(65 + at)
            if isinstance(value, (int, float)):
                out.append(f'<c r="{letter}{number}"><v>{value!r}</v></c>')
            else:
                out.append(f'<c r="{letter}{number}" t="inlineStr"><is><t>{_text(str(value))}</t></is></c>')
        out.append("</row>")
    return (
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        + "".join(out) + "</sheetData></worksheet>"
    )


@lru_cache(maxsize=16)
def _contents(names: tuple[str, ...]) -> tuple[str, str]:
    """The two tables of contents of a workbook with these sheets."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
    rels = "".join(
        f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(names) + 1)
    )
    return (
        f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>',
        f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>',
    )


def workbook_bytes(sheets: dict[str, list[list[object]]]) -> bytes:
    """A minimal workbook; used to put table rows into report files."""
    workbook, rels = _contents(tuple(sheets))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:

        def put(name: str, text: str) -> None:
            book.writestr(zipfile.ZipInfo(name), text)  # a fixed date: equal contents are equal bytes

        put("xl/workbook.xml", workbook)
        put("xl/_rels/workbook.xml.rels", rels)
        for i, rows in enumerate(sheets.values(), 1):
            put(f"xl/worksheets/sheet{i}.xml", _sheet(rows))
    return buffer.getvalue()


def customer_report(key: int, name: str, segment: str, balance: float) -> bytes:
    """A report for one customer: one open position, four cash operations, one closed position."""
    account = ["Account number", 10_000_000 + key]
    closed = [None] * 25
    closed[0], closed[1], closed[8], closed[16], closed[23] = "Widget", "WDG.DE", 46236.25, (key % 50) / 4, 500 + key
    return workbook_bytes(
        {
            "OPEN POSITIONS": [
                account,
                ["Product", "Metric", "Amount", "Currency"],
                ["My Trades", "Value", balance, "PLN" if key % 2 else "EUR"],
                ["Note"],
                ["Product", "Instrument/Position", "Ticker", "Category", "Type", "Volume", "Value"],
                ["My Trades", name, f"{segment}.DE", "ETF", None, 1, balance],
                ["My Trades", name, f"{segment}.DE", None, "BUY", 1, 7],
                ["My Trades", "Sold", "SOLD.DE", "ETF", None, 0, 0.0],
            ],
            "CASH OPERATIONS": [
                account,
                ["Type", "Instrument", "Ticker", "Category", "Time", "Amount", "ID", "Comment", "Product", "Position ID"],
                ["Deposit", None, None, None, 46000.5, balance, 10 * key + 1, "in", "My Trades"],
                ["Subaccount transfer", None, None, None, 46001, 1.0, 10 * key + 2],
                ["Stock sell", "Widget", "WDG.DE", "ETF", 46002.25, "1 234,50", 10 * key + 3,
                 f"CLOSE BUY {key % 9 + 1}.5 @ 12.25", "My Trades", 500 + key],
                ["Free funds interest tax", None, None, None, 46003, -0.25, 10 * key + 4, "tax"],
                ["Total", None, None, None, None, balance],
            ],
            "CLOSED POSITIONS": [account, ["Instrument", "Ticker", "Category"], closed, ["Profit/loss"]],
        }
    )


_BUILT: dict[tuple[str, str], DataFrame] = {}


def customer_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One workbook per customer as raw rows, built once a session and read from the shared folder."""
    at = spark.sparkContext.applicationId, sf_dir
    if at not in _BUILT:
        _BUILT[at] = Scratch(spark).written(_built_workbooks(spark, sf_dir), "customer-workbooks")
    return _BUILT[at]


def _built_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            books = [customer_report(*r) for r in zip(b.c_custkey.tolist(), b.c_name, b.c_mktsegment, b.c_acctbal.tolist())]
            yield pd.DataFrame({"c_custkey": b.c_custkey, "payload": books})

    columns = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    made = dealt(columns).mapInPandas(build, "c_custkey bigint, payload binary")
    return made.selectExpr(
        "TIMESTAMP'2024-01-01 00:00:00' AS fetched_at", "'XTB' AS broker", "'XTB_REPORT' AS source", "payload",
        "CAST(c_custkey AS STRING) AS payload_hash",
        "concat('PLN_', 10000000 + c_custkey, '_2006-01-01_2026-08-03.xlsx') AS source_file",
    )
