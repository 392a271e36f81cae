"""Registered queries: each operator over whole tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.brokers import ibkr, trading212, xtb
from tally.functions import fernet
from tally.functions import values as V
from tally.operators import report as R
from tally.operators.currency import convert, normalize_currency, rates_frame, unconvertible
from tally.operators.dedup import (
    ADDRESS, IBKR_EVENT_KEY, LEDGER_EVENT_KEY, TRADING212_EVENT_KEY, XTB_EVENT_KEY, addressed, dedup_newest, drop_known,
    duplicates_removed, latest_per_source, merge_newest, orphans,
)
from tally.operators.holdings import aggregate_percentages, extract_holdings, portfolio_holdings
from tally.operators.income import (
    cash_flow_summary, dividend_income, interest_income, lacks_target, unreadable_times, with_periods,
)
from tally.operators.ledger import consolidate_events
from tally.operators.maintenance import raw_vocabulary, replace_value
from tally.operators.quality import null_report, previous_counts, results_frame, table_checks, uncovered
from tally.operators.shaping import conform
from tally.plans import workload as L
from tally.plans.jobs import ingest_raw
from tally.schemas import EVENTS, EVENTS_MONEY, plain
from tally.session import use_utc
from tally.sources.json_payloads import decode_rows, explode_events
from tally.sources.workbook import header_is, locate_body, sheet_rows
from tally.sources.xml_statements import conversion_rates

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def add(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_utc(spark), sf_dir)

        QUERIES[name] = Query(run, sql)
        return build

    return add


STAMP = "%Y-%m-%d %H:%M:%S.%f"


def stamp(column: str) -> F.Column:
    """Timestamp as text with six digits, the same on both sides."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def docs(spark: SparkSession, d: str, with_address: bool = False) -> DataFrame:
    """Documents as raw rows: the text is the payload, fetched in five rounds."""
    read = L.table(spark, d, "documents")
    return (addressed(read) if with_address else read).selectExpr(
        "timestampadd(DAY, CAST(doc_id % 5 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS fetched_at",
        "'IBKR' AS broker", "source", "CAST(text AS BINARY) AS payload", "sha2(CAST(text AS BINARY), 256) AS payload_hash",
        "concat('f', doc_id) AS source_file", "doc_id", *(ADDRESS if with_address else ()),
    )


DOCS_SQL = """docs AS (SELECT TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 5 AS INTEGER)) AS fetched_at,
  'IBKR' AS broker, source, sha256(text) AS payload_hash, 'f' || doc_id AS source_file, doc_id FROM documents)"""


# ================================================================ raw layer, dedup


@register(
    "raw_dedup_new_payloads",
    f"""WITH {DOCS_SQL}, known AS (SELECT DISTINCT broker, source, payload_hash FROM docs WHERE doc_id % 2 = 0)
    SELECT d.doc_id, d.source, d.payload_hash FROM docs d
    WHERE NOT EXISTS (SELECT 1 FROM known k
      WHERE k.broker = d.broker AND k.source = d.source AND k.payload_hash = d.payload_hash)""",
)
def _(spark, d):
    incoming = docs(spark, d)
    return drop_known(incoming, docs(spark, d).filter("doc_id % 2 = 0")).select("doc_id", "source", "payload_hash")


@register(
    "ingest_batches",
    f"""WITH {DOCS_SQL}, known AS (SELECT DISTINCT source, payload_hash FROM docs WHERE doc_id % 2 = 0)
    SELECT d.source_file, d.source, d.payload_hash, strftime(d.fetched_at, '{STAMP}') AS fetched_at, CAST(doc_id % 2 AS INTEGER) AS batch
    FROM docs d WHERE doc_id % 2 = 0 OR NOT EXISTS (SELECT 1 FROM known k WHERE k.source = d.source AND k.payload_hash = d.payload_hash)""",
)
def _(spark, d):
    """Two batches, the second with all of the first one's content again, through encryption, key index and lake."""
    rows = docs(spark, d)
    ledger = L.new_ledger(spark, "ingest")
    ingest_raw(ledger, rows.filter("doc_id % 2 = 0"), "ibkr", hand_on=False)
    ingest_raw(ledger, rows, "ibkr", hand_on=False)
    stored = ledger.lake.read("raw", "ibkr")
    opened = decode_rows(stored, ledger.key, require_json=False).withColumn("payload_hash", F.sha2("body", 256))
    return opened.select(
        "source_file", "source", "payload_hash", stamp("fetched_at"), (F.substring("source_file", 2, 20).cast("long") % 2).cast("int").alias("batch")
    )


@register(
    "latest_snapshot_per_source",
    f"""WITH {DOCS_SQL} SELECT doc_id, source, strftime(fetched_at, '{STAMP}') AS fetched_at FROM docs
    QUALIFY fetched_at = max(fetched_at) OVER (PARTITION BY source)""",
)
def _(spark, d):
    return latest_per_source(docs(spark, d)).select("doc_id", "source", stamp("fetched_at"))


def _dedup_sql(keys: str) -> str:
    return f"""WITH {L.REPLAYED_SQL}
    SELECT broker, event_type, event_id, account_id, strftime(fetched_at, '{STAMP}') AS fetched_at,
      CAST(cash_amount AS DOUBLE) AS cash_amount
    FROM replayed QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY fetched_at DESC, event_id, cash_amount) = 1"""


def _dedup_query(keys: tuple[str, ...]) -> Build:
    def build(spark, d):
        newest = dedup_newest(L.replayed(spark, d), keys, tiebreak=[F.col("event_id"), F.col("cash_amount")])
        return newest.select(
            "broker", "event_type", "event_id", "account_id", stamp("fetched_at"), F.col("cash_amount").cast("double")
        )

    return build


for _name, _keys in {
    "event_dedup_newest": LEDGER_EVENT_KEY,
    "event_dedup_ibkr": IBKR_EVENT_KEY,
    "event_dedup_trading212": TRADING212_EVENT_KEY,
    "event_dedup_xtb": XTB_EVENT_KEY,
}.items():
    register(_name, _dedup_sql(", ".join(_keys)))(_dedup_query(_keys))


@register(
    "event_dedup_hot_key",
    f"""WITH {L.LEDGER_SQL} SELECT event_type, strftime(max(fetched_at), '{STAMP}') AS fetched_at
    FROM ledger GROUP BY event_type""",
)
def _(spark, d):
    # five keys only: most rows are copies of a key, which the map-side limit folds
    return dedup_newest(L.ledger(spark, d), ["event_type"], tiebreak=[F.col("event_id")]).select(
        "event_type", stamp("fetched_at")
    )


@register(
    "dedup_removed_count",
    f"""WITH {L.REPLAYED_SQL}, k AS (SELECT count(*) AS n FROM replayed GROUP BY broker, event_type, event_id, account_id)
    SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS kept, CAST(sum(n - 1) AS BIGINT) AS removed FROM k""",
)
def _(spark, d):
    return duplicates_removed(L.replayed(spark, d), LEDGER_EVENT_KEY)


@register(
    "consolidate_events",
    f"""WITH {L.REPLAYED_SQL}
    SELECT broker, event_type, event_id, account_id, security_ccy, strftime(fetched_at, '{STAMP}') AS fetched_at,
      CAST(cash_amount AS DOUBLE) AS cash_amount
    FROM replayed
    QUALIFY row_number() OVER (PARTITION BY broker, event_type, event_id, account_id
      ORDER BY fetched_at DESC, cash_amount) = 1""",
)
def _(spark, d):
    rows = L.replayed(spark, d)
    frames = [rows.filter(F.col("broker") == b) for b in ("IBKR", "Trading 212", "XTB")]
    merged = consolidate_events(spark, [*frames, None], tiebreak=[F.col("cash_amount")])
    return merged.select(
        "broker", "event_type", "event_id", "account_id", "security_ccy", stamp("fetched_at"), "cash_amount"
    )


@register(
    "merge_dedup_raw",
    f"""WITH {DOCS_SQL}, twice AS (SELECT * FROM docs UNION ALL
      SELECT * REPLACE (fetched_at + INTERVAL 7 DAY AS fetched_at) FROM docs WHERE doc_id % 3 = 0)
    SELECT source, payload_hash, source_file, strftime(fetched_at, '{STAMP}') AS fetched_at FROM twice
    QUALIFY row_number() OVER (PARTITION BY broker, source, payload_hash ORDER BY fetched_at DESC, source_file) = 1""",
)
def _(spark, d):
    first = docs(spark, d, with_address=True)
    later = first.filter("doc_id % 3 = 0").withColumn("fetched_at", F.expr("fetched_at + INTERVAL 7 DAY"))
    both = first.unionByName(later.withColumn("__file", F.concat("__file", F.lit("#later"))))
    merged = merge_newest(both, ["source_file"], ADDRESS)
    return merged.select("source", "payload_hash", "source_file", stamp("fetched_at"))


@register(
    "merge_orphan_keys",
    f"""WITH {DOCS_SQL} SELECT DISTINCT broker, source, payload_hash FROM docs d
    WHERE NOT EXISTS (SELECT 1 FROM docs m WHERE m.doc_id % 2 = 0 AND m.source = d.source AND m.payload_hash = d.payload_hash)""",
)
def _(spark, d):
    return orphans(docs(spark, d), docs(spark, d).filter("doc_id % 2 = 0"))


@register(
    "raw_vocabulary",
    "SELECT 'IBKR' AS broker, source, count(*) AS rows FROM documents GROUP BY source",
)
def _(spark, d):
    return raw_vocabulary(docs(spark, d))


@register(
    "rewrite_source_value",
    "SELECT doc_id, CASE WHEN source = 'src1' THEN 'flex_events' ELSE source END AS source FROM documents",
)
def _(spark, d):
    return replace_value(docs(spark, d), "source", "src1", "flex_events").select("doc_id", "source")


# ================================================================ classification, scalar functions


@register(
    "classify_ibkr_cash_type",
    """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'DIVIDEND' WHEN 1 THEN 'TAX' WHEN 2 THEN 'INTEREST'
      WHEN 3 THEN 'FEE' WHEN 4 THEN CASE WHEN o_custkey % 3 = 0 THEN 'WITHDRAWAL' ELSE 'DEPOSIT' END
      WHEN 5 THEN 'ADJUSTMENT' ELSE 'UNKNOWN' END AS event_type FROM orders""",
)
def _(spark, d):
    kind = ibkr.classify_cash(F.expr(L.CASH_TYPE), F.expr(L.CASH_AMOUNT))
    return L.table(spark, d, "orders").select("o_orderkey", kind.alias("event_type"))


@register(
    "classify_trading212_transactions",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'WITHDRAWAL' WHEN 'signup' THEN 'DEPOSIT'
      WHEN 'error' THEN 'FEE' WHEN 'view' THEN 'TRANSFER' ELSE 'UNKNOWN' END AS kind FROM events""",
)
def _(spark, d):
    raw = F.expr(
        "CASE event_type WHEN 'purchase' THEN 'WITHDRAW' WHEN 'signup' THEN 'DEPOSIT' WHEN 'error' THEN 'FEE' "
        "WHEN 'view' THEN 'TRANSFER' ELSE event_type END"
    )
    return L.table(spark, d, "events").select(
        "event_id", V.lookup(trading212.TRANSACTION_TYPES, raw, "UNKNOWN").alias("kind")
    )


@register(
    "classify_xtb_operations",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'TRADE' WHEN 'signup' THEN 'DEPOSIT'
      WHEN 'error' THEN 'TAX' WHEN 'view' THEN 'ADJUSTMENT' ELSE 'UNKNOWN' END AS kind FROM events""",
)
def _(spark, d):
    raw = F.expr(
        "CASE event_type WHEN 'purchase' THEN 'Close position' WHEN 'signup' THEN 'Deposit' "
        "WHEN 'error' THEN 'Free funds interest tax' WHEN 'view' THEN 'Correction' ELSE event_type END"
    )
    return L.table(spark, d, "events").select("event_id", xtb.classify_operation(raw).alias("kind"))


@register(
    "deterministic_event_id",
    """SELECT o_orderkey, substr(sha256('Trade|' || o_custkey || '|' || strftime(o_orderdate, '%Y%m%d') || '||'
      || o_orderstatus), 1, 16) AS event_id FROM orders""",
)
def _(spark, d):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    made = V.event_hash(F.lit("Trade"), F.col("o_custkey").cast("string"), day, F.lit(None).cast("string"), "o_orderstatus")
    return L.table(spark, d, "orders").select("o_orderkey", made.alias("event_id"))


@register(
    "period_columns",
    f"WITH {L.LEDGER_SQL} SELECT event_id, period_month, period_quarter FROM ledger",
)
def _(spark, d):
    return with_periods(L.ledger(spark, d)).select("event_id", "period_month", "period_quarter")


@register(
    "unreadable_event_times",
    """SELECT CAST(count(*) FILTER (WHERE event_id % 5 IN (2, 4)) AS BIGINT) AS unreadable FROM events""",
)
def _(spark, d):
    rows = L.ledger(spark, d).withColumn(
        "event_datetime",
        F.expr("CASE CAST(event_id AS BIGINT) % 5 WHEN 2 THEN replace(event_datetime, ' ', 'T') "
               "WHEN 4 THEN 'soon' ELSE event_datetime END"),
    )
    return unreadable_times(rows)


@register(
    "iso_datetime",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') ELSE strftime(o_orderdate, '%Y/%m/%d') END AS iso FROM orders""",
)
def _(spark, d):
    text = F.expr(
        "CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, \"yyyyMMdd';'HHmmss\") "
        "WHEN 1 THEN date_format(o_orderdate, 'yyyyMMdd') ELSE date_format(o_orderdate, 'yyyy/MM/dd') END"
    )
    return L.table(spark, d, "orders").select("o_orderkey", V.iso_datetime(text).alias("iso"))


@register(
    "safe_and_european_float",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS european,
      CASE WHEN l_linenumber <= 2 THEN CAST(1 AS DOUBLE) WHEN l_linenumber = 3 THEN CAST(1000 AS DOUBLE)
        ELSE l_discount END AS safe FROM lineitem""",
)
def _(spark, d):
    comma = F.concat(F.lit(" "), F.translate(F.col("l_extendedprice").cast("string"), ".", ","), F.lit(" "))
    line, discount = F.col("l_linenumber"), F.col("l_discount").cast("string")
    # a suffix is no number; an underscore within one, and odd blanks around it, are allowed
    text = (
        F.when(line == 1, F.lit("n/a")).when(line == 2, F.concat(discount, F.lit("d"))).when(line == 3, F.lit("\u2003+1_0.0e2\u00a0"))
        .otherwise(F.concat(F.lit("\t"), discount, F.lit("\u00a0")))
    )
    return L.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        V.european_float(comma).alias("european"), V.safe_float(text, 1.0).alias("safe"),
    )


@register(
    "excel_serial_timestamp",
    f"SELECT event_id, CASE WHEN event_id % 9 > 2 THEN strftime(date_trunc('milliseconds', ts), '{STAMP}') END AS at FROM events",
)
def _(spark, d):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    serial = (millis.cast("double") / F.lit(86400000.0) + F.lit(25569.0)).cast("string")
    kind = F.col("event_id") % 9
    text = F.when(kind == 0, F.lit("nan")).when(kind == 1, F.lit("soon")).when(kind == 2, F.lit("4e9")).otherwise(serial)
    rows = L.table(spark, d, "events").select("event_id", V.excel_timestamp(text).alias("at"))
    return rows.select("event_id", stamp("at"))


@register(
    "trade_comment_extract",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN CASE WHEN o_orderstatus = 'F' THEN 'SELL' ELSE 'BUY' END END AS side,
      CASE WHEN o_orderkey % 5 <> 4 THEN CAST(o_custkey AS DOUBLE) END AS quantity,
      CASE WHEN o_orderkey % 5 <> 4 THEN o_totalprice END AS price FROM orders""",
)
def _(spark, d):
    comment = F.expr(
        "CASE WHEN o_orderkey % 5 = 4 THEN 'moved to savings' ELSE concat(' ', "
        "CASE WHEN o_orderkey % 2 = 0 THEN 'OPEN' ELSE 'CLOSE' END, ' ', "
        "CASE WHEN o_orderstatus = 'F' THEN 'SELL' ELSE 'BUY' END, ' ', o_custkey, ' @ ', CAST(o_totalprice AS STRING), ' x') END"
    )
    parts = V.trade_comment(comment)
    return L.table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@register(
    "ticker_normalize",
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 4 THEN 'CASH EUR' WHEN 5 THEN 'P' || p_partkey || 'x' ELSE 'P' || p_partkey END
      AS ticker FROM part""",
)
def _(spark, d):
    raw = F.expr(
        "CASE p_partkey % 6 WHEN 0 THEN concat('P', p_partkey, 'l_EQ') WHEN 1 THEN concat('P', p_partkey, '_US_EQ') "
        "WHEN 2 THEN concat('P', p_partkey, '_ETF') WHEN 3 THEN concat('P', p_partkey, '_DE') WHEN 4 THEN 'CASH EUR' "
        "ELSE concat('P', p_partkey, 'x') END"
    )
    return L.table(spark, d, "part").select("p_partkey", V.normalize_ticker(raw).alias("ticker"))


@register(
    "account_from_file_name",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_custkey AS VARCHAR) END AS account_id,
      'PLN_' || CASE WHEN o_orderkey % 3 < 2 THEN '' ELSE 'x' END || o_custkey || '_a+b c.xlsx' AS file_name FROM orders""",
)
def _(spark, d):
    key = F.expr(
        "concat('landing/xtb/PLN_', CASE WHEN o_orderkey % 3 < 2 THEN '' ELSE 'x' END, o_custkey, '_a+b%20c.xlsx')"
    )
    return L.table(spark, d, "orders").select(
        "o_orderkey", V.account_from_file_name(key).alias("account_id"), V.file_name(key).alias("file_name")
    )


@register(
    "header_cell_normalize",
    "SELECT p_partkey, lower(p_name) || ' ' || lower(p_type) AS header FROM part",
)
def _(spark, d):
    messy = F.expr("concat('  ', upper(p_name), ' \t\n ', p_type, ' ')")
    return L.table(spark, d, "part").select("p_partkey", V.header_text(messy).alias("header"))


# ================================================================ currency, holdings


@register(
    "normalize_currency",
    f"""WITH {L.REPLAYED_SQL}, {L.convert_sql('replayed')}
    SELECT event_id, strftime(fetched_at, '{STAMP}') AS fetched_at, security_ccy, CAST(fx_rate AS DOUBLE) AS target_fx_rate,
      CAST(target_value AS DOUBLE) AS target_value, target_ccy FROM converted""",
)
def _(spark, d):
    rows = normalize_currency(L.replayed(spark, d), L.rates(spark), L.TARGET)
    return rows.select(
        "event_id", stamp("fetched_at"), "security_ccy", F.col("target_fx_rate").cast("double"),
        F.col("target_value").cast("double"), "target_ccy",
    )


@register(
    "convert_currency",
    f"""WITH {L.HOLDINGS_SQL} SELECT security_ccy, count(*) AS holdings, CAST(sum(target_value) AS DOUBLE) AS converted
    FROM consolidated GROUP BY security_ccy""",
)
def _(spark, d):
    rows = convert(L.holdings(spark, d), "security_value", "security_ccy", L.rates(spark), L.TARGET)
    return rows.groupBy("security_ccy").agg(
        F.count(F.lit(1)).alias("holdings"), F.sum("converted").cast("double").alias("converted")
    )


@register(
    "unconvertible_currencies",
    f"WITH {L.LEDGER_SQL} SELECT DISTINCT 'X' || security_ccy AS ccy FROM ledger",
)
def _(spark, d):
    rows = L.ledger(spark, d).withColumn("security_ccy", F.concat(F.lit("x"), "security_ccy"))
    return unconvertible(rows, "security_ccy", L.rates(spark), L.TARGET)


@register(
    "unconvertible_many",
    "SELECT DISTINCT 'X' || c_custkey AS ccy FROM customer",
)
def _(spark, d):
    rows = L.table(spark, d, "customer").select(F.concat(F.lit("x"), "c_custkey").alias("security_ccy"))
    return unconvertible(rows, "security_ccy", L.rates(spark), L.TARGET)


@register(
    "rates_table_with_overrides",
    """WITH listed AS (SELECT 'C' || n_nationkey AS ccy, n_nationkey / CAST(8 AS DOUBLE) AS rate FROM nation
      UNION ALL SELECT 'GBP', CAST(1.5 AS DOUBLE)),
    best AS (SELECT ccy, CASE ccy WHEN 'C3' THEN CAST(9.5 AS DOUBLE) ELSE rate END AS rate FROM listed WHERE rate <> 0
      UNION ALL SELECT 'NEW', CAST(2 AS DOUBLE))
    SELECT ccy, rate FROM best UNION ALL SELECT 'GBX', CAST(0.015 AS DOUBLE)""",
)
def _(spark, d):
    listed = L.table(spark, d, "nation").select(
        F.concat(F.lit("c"), "n_nationkey").alias("ccy"), (F.col("n_nationkey") / F.lit(8.0)).alias("rate")
    )
    missing = spark.range(1).selectExpr("'GBP' AS ccy", "CAST(1.5 AS DOUBLE) AS rate")
    return rates_frame(spark, listed.unionAll(missing), {"C3": 9.5, "new": 2.0})


@register(
    "conform_iso_time",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS fetched_at FROM events",
)
def _(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    rows = L.table(spark, d, "events").select("event_id", text.alias("fetched_at"))
    return conform(rows, plain(EVENTS)).select("event_id", stamp("fetched_at"))


@register(
    "target_guard",
    f"""WITH {L.CONVERTED_SQL} SELECT count(*) FILTER (WHERE CAST(event_id AS BIGINT) % 11 = 0) AS lacking, count(*) AS events FROM converted""",
)
def _(spark, d):
    some = F.col("event_id").cast("bigint") % 11 == 0
    rows = L.converted(spark, d).withColumn("target_value", F.when(~some, F.col("target_value")))
    return rows.agg(F.count_if(lacks_target()).alias("lacking"), F.count(F.lit(1)).alias("events"))


@register(
    "consolidate_holdings",
    f"""WITH {L.HOLDINGS_SQL} SELECT broker, ticker, CAST(security_value AS DOUBLE) AS security_value, security_ccy,
      CAST(target_value AS DOUBLE) AS target_value, target_ccy, identifier, description, position_type FROM consolidated""",
)
def _(spark, d):
    return doubles(L.consolidated(spark, d).drop("fetched_at"), "security_value", "target_value")


@register(
    "extract_holdings",
    """SELECT 'IBKR' AS broker, c_name AS ticker, c_acctbal AS security_value, 'EUR' AS security_ccy,
      CASE WHEN c_custkey % 2 = 0 THEN 'ISIN:' || c_mktsegment ELSE '' END AS identifier, '' AS description, 'EQUITY' AS position_type
    FROM customer
    UNION ALL SELECT 'XTB', c_name, c_acctbal, 'EUR', 'TICKER:' || c_name, '', 'EQUITY' FROM customer""",
)
def _(spark, d):
    rows = L.table(spark, d, "customer").selectExpr(
        "concat(c_name, ' ') AS label", "c_acctbal AS security_value", "'EUR' AS security_ccy",
        "CASE WHEN c_custkey % 2 = 0 THEN concat(' ', c_mktsegment) END AS isin",
        "CAST(NULL AS STRING) AS description", "CAST(NULL AS STRING) AS position_type",
    )
    trimmed = rows.withColumn("label", F.trim("label"))
    return extract_holdings(trimmed, "ibkr").unionByName(extract_holdings(rows, "xtb"))


@register(
    "portfolio_percentage",
    f"""WITH {L.HOLDINGS_SQL} SELECT broker, ticker, security_ccy, CAST(security_value AS DOUBLE) AS security_value,
      CAST(target_value AS DOUBLE) AS target_value, CAST(percentage AS DOUBLE) AS percentage, position_type FROM gold""",
)
def _(spark, d):
    rows = portfolio_holdings(L.consolidated(spark, d))
    return doubles(rows, "security_value", "target_value").select(
        "broker", "ticker", "security_ccy", "security_value", "target_value", "percentage", "position_type"
    )


@register(
    "aggregate_percentages",
    f"""WITH {L.HOLDINGS_SQL} SELECT ticker, broker, CAST(sum(target_value) AS DOUBLE) / (SELECT t FROM whole) * 100.0 AS percentage,
      coalesce(min(nullif(identifier, '-')), '-') AS identifier, min(security_ccy) AS security_ccy, min(description) AS description
    FROM consolidated GROUP BY ticker, broker HAVING sum(target_value) <> 0""",
)
def _(spark, d):
    return aggregate_percentages(L.holdings(spark, d), L.rates(spark), L.TARGET)


# ================================================================ income tables

_SUMS_SQL = """CAST(sum(cash_amount) AS DOUBLE) AS cash_amount, CAST(sum(target_value) AS DOUBLE) AS target_value,
      min(target_ccy) AS target_ccy, count(event_id) AS event_count"""


@register(
    "dividend_income",
    f"""WITH {L.CONVERTED_SQL} SELECT period_month, period_quarter, broker, ticker, isin, description, security_ccy, {_SUMS_SQL},
      min(instrument_ccy) AS instrument_ccy FROM converted WHERE event_type = 'DIVIDEND'
    GROUP BY period_month, period_quarter, broker, ticker, isin, description, security_ccy""",
)
def _(spark, d):
    return dividend_income(L.converted(spark, d))


@register(
    "interest_income",
    f"""WITH {L.CONVERTED_SQL} SELECT period_month, period_quarter, broker, security_ccy, {_SUMS_SQL}
    FROM converted WHERE event_type = 'INTEREST' GROUP BY period_month, period_quarter, broker, security_ccy""",
)
def _(spark, d):
    return interest_income(L.converted(spark, d))


@register(
    "cash_flow_summary",
    f"""WITH {L.CONVERTED_SQL} SELECT period_month, period_quarter, broker, event_type, security_ccy, {_SUMS_SQL}
    FROM converted GROUP BY period_month, period_quarter, broker, event_type, security_ccy""",
)
def _(spark, d):
    return cash_flow_summary(L.converted(spark, d))


@register(
    "ledger_end_to_end",
    f"""WITH {L.REPLAYED_SQL}, newest AS (SELECT * FROM replayed
      QUALIFY row_number() OVER (PARTITION BY broker, event_type, event_id, account_id ORDER BY fetched_at DESC, cash_amount) = 1),
    {L.convert_sql('newest')}
    SELECT period_month, period_quarter, broker, event_type, security_ccy, {_SUMS_SQL}
    FROM converted GROUP BY period_month, period_quarter, broker, event_type, security_ccy""",
)
def flagship(spark, d):
    """Replay removal, conversion and cash-flow summary in one plan."""
    newest = dedup_newest(L.replayed(spark, d), LEDGER_EVENT_KEY, tiebreak=[F.col("cash_amount")])
    return cash_flow_summary(with_periods(normalize_currency(newest, L.rates(spark), L.TARGET, check=False)))


# ================================================================ report data sets


def _gold(name: str, sql: str, build: Callable[[DataFrame], DataFrame]) -> None:
    register(name, f"WITH {L.HOLDINGS_SQL} {sql}")(lambda spark, d: build(L.gold_holdings(spark, d)))


_gold(
    "allocation_by_broker",
    "SELECT broker, CAST(sum(percentage) AS DOUBLE) AS percentage FROM gold GROUP BY broker",
    R.allocation_by_broker,
)
_gold(
    "allocation_by_currency",
    "SELECT security_ccy, CAST(sum(percentage) AS DOUBLE) AS percentage FROM gold GROUP BY security_ccy",
    R.allocation_by_currency,
)
_gold(
    "positions",
    """SELECT ticker, CAST(sum(percentage) AS DOUBLE) AS percentage, min(position_type) AS position_type
    FROM gold GROUP BY ticker""",
    R.positions,
)
_gold(
    "currency_allocation",
    """SELECT security_ccy, round(CAST(sum(percentage) AS DOUBLE), 2) AS total_pct, count(*) AS positions
    FROM gold GROUP BY security_ccy""",
    R.currency_allocation,
)
_gold(
    "cross_broker_tickers",
    """SELECT ticker, count(DISTINCT broker) AS broker_count, CAST(sum(percentage) AS DOUBLE) AS total_pct
    FROM gold GROUP BY ticker HAVING count(DISTINCT broker) > 1""",
    R.cross_broker_tickers,
)
_VALUE_SHARE = """SELECT {key}, CAST(sum(target_value) AS DOUBLE) AS total,
    CAST(sum(target_value) AS DOUBLE) / (SELECT t FROM whole) * 100.0 AS share FROM gold GROUP BY {key}"""
_gold("summary_by_broker", _VALUE_SHARE.format(key="broker"), R.summary_by_broker)
_gold("summary_by_type", _VALUE_SHARE.format(key="position_type"), R.summary_by_type)
_gold(
    "equity_cash_split",
    """SELECT round_even(CAST(sum(percentage) FILTER (WHERE position_type = 'EQUITY') AS DOUBLE), 1) AS equity_pct,
      round_even(CAST(sum(percentage) FILTER (WHERE position_type = 'CASH') AS DOUBLE), 1) AS cash_pct FROM gold""",
    R.equity_cash_split,
)
_gold(
    "total_value",
    "SELECT CAST(sum(target_value) AS DOUBLE) AS total_value, min(target_ccy) AS target_ccy FROM gold",
    R.total_value,
)


def _of_type(spark, d, kind: str) -> DataFrame:
    return L.converted(spark, d).filter(F.col("event_type") == kind)


@register(
    "passive_income_timeline",
    f"""WITH {L.CONVERTED_SQL} SELECT period_month, CASE event_type WHEN 'DIVIDEND' THEN 'Dividends' ELSE 'Interest' END AS series,
      CAST(sum(target_value) AS DOUBLE) AS total FROM converted WHERE event_type IN ('DIVIDEND', 'INTEREST')
    GROUP BY period_month, event_type""",
)
def _(spark, d):
    return R.passive_income(_of_type(spark, d, "DIVIDEND"), _of_type(spark, d, "INTEREST"))


@register(
    "passive_income_totals",
    f"""WITH {L.CONVERTED_SQL} SELECT CASE event_type WHEN 'DIVIDEND' THEN 'Dividends' ELSE 'Interest' END AS series,
      CAST(sum(target_value) AS DOUBLE) AS total, min(target_ccy) AS target_ccy FROM converted
    WHERE event_type IN ('DIVIDEND', 'INTEREST') GROUP BY event_type""",
)
def _(spark, d):
    return R.passive_income_totals(_of_type(spark, d, "DIVIDEND"), _of_type(spark, d, "INTEREST"))


def _daily_flows(spark, d) -> DataFrame:
    """Cash flows with the minute as period, in which types are missing here and there."""
    rows = normalize_currency(L.ledger(spark, d), L.rates(spark), L.TARGET, check=False)
    return rows.withColumn("period_month", F.date_format("fetched_at", "yyyy-MM-dd HH:mm"))


_FLOWS_SQL = f"""WITH {L.CONVERTED_SQL}, flows AS (SELECT event_type, strftime(fetched_at, '%Y-%m-%d %H:%M') AS period_month,
      CAST(sum(target_value) AS DOUBLE) AS value FROM converted GROUP BY 1, 2)"""


@register(
    "cash_flow_grid",
    _FLOWS_SQL + """ SELECT t.event_type, m.period_month, coalesce(f.value, CAST(0 AS DOUBLE)) AS value
    FROM (SELECT DISTINCT event_type FROM flows) t CROSS JOIN (SELECT DISTINCT period_month FROM flows) m
    LEFT JOIN flows f ON f.event_type = t.event_type AND f.period_month = m.period_month""",
)
def _(spark, d):
    return R.cash_flow_grid(_daily_flows(spark, d))


@register(
    "cash_flow_outliers",
    _FLOWS_SQL + """, scaled AS (SELECT event_type, CASE WHEN event_type = 'FEE' THEN value / 1000.0 ELSE value END AS value FROM flows),
    p AS (SELECT event_type, max(abs(value)) AS peak FROM scaled GROUP BY event_type),
    b AS (SELECT a.event_type, a.peak, (SELECT max(peak) FROM p) / 100.0 AS floor,
      (SELECT min(o.peak) FROM p o WHERE o.event_type <> a.event_type AND o.peak > 0) AS other FROM p a)
    SELECT event_type, peak, coalesce(peak > 10.0 * greatest(other, floor), false) AS is_outlier FROM b""",
)
def _(spark, d):
    daily = _daily_flows(spark, d).groupBy("event_type", "period_month").agg(
        F.sum("target_value").cast("double").alias("target_value")
    )
    small = F.when(F.col("event_type") == "FEE", F.col("target_value") / F.lit(1000.0)).otherwise(F.col("target_value"))
    return R.cash_flow_outliers(R.cash_flow_peaks(daily.withColumn("target_value", small)))


# ================================================================ quality


def _holed(spark, d) -> DataFrame:
    rows = L.ledger(spark, d)
    return rows.withColumns(
        {
            "cash_amount": F.expr("CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN NULL ELSE cash_amount END"),
            "broker": F.expr("CASE WHEN CAST(event_id AS BIGINT) % 13 = 0 THEN NULL ELSE broker END"),
        }
    )


@register(
    "dq_required_nulls",
    """SELECT 'fetched_at' AS field, CAST(0 AS BIGINT) AS nulls UNION ALL
    SELECT 'broker', count(*) FROM events WHERE event_id % 13 = 0 UNION ALL
    SELECT 'event_id', 0 UNION ALL SELECT 'event_type', 0 UNION ALL
    SELECT 'cash_amount', count(*) FROM events WHERE event_id % 7 = 0""",
)
def _(spark, d):
    return null_report(_holed(spark, d), ("fetched_at", "broker", "event_id", "event_type", "cash_amount"))


@register(
    "dq_reconciliation",
    f"""WITH {L.HOLDINGS_SQL}, {L.LEDGER_SQL}
    SELECT DISTINCT 'broker' AS kind, broker AS value FROM held WHERE broker NOT IN (SELECT broker FROM ledger)
    UNION ALL
    SELECT DISTINCT 'currency', target_ccy FROM consolidated WHERE target_ccy NOT IN (SELECT security_ccy FROM ledger)""",
)
def _(spark, d):
    held = L.consolidated(spark, d)
    events = L.ledger(spark, d)
    brokers = uncovered(held, events, "broker", "broker").withColumn("kind", F.lit("broker"))
    codes = uncovered(held, events, "target_ccy", "security_ccy")
    return brokers.unionByName(codes.withColumn("kind", F.lit("currency"))).select("kind", "value")


@register(
    "dq_freshness",
    f"""WITH {L.LEDGER_SQL} SELECT broker, strftime(max(fetched_at), '{STAMP}') AS newest,
      max(fetched_at) < TIMESTAMP '2024-01-30 23:00:00' AS stale, count(*) AS rows FROM ledger GROUP BY broker""",
)
def _(spark, d):
    facts = L.ledger(spark, d).groupBy("broker").agg(F.max("fetched_at").alias("newest"), F.count(F.lit(1)).alias("rows"))
    return facts.select(
        "broker", stamp("newest"), (F.col("newest") < F.lit("2024-01-30 23:00:00").cast("timestamp_ntz")).alias("stale"), "rows"
    )


@register(
    "dq_table_checks",
    """WITH n AS (SELECT count(*) AS rows, max(ts) AS newest FROM events)
    SELECT 'ibkr_events' AS table_name, 'schema' AS check_name, 'PASS' AS status, CAST(NULL AS VARCHAR) AS actual
    UNION ALL SELECT 'ibkr_events', 'required_nulls', 'FAIL', NULL
    UNION ALL SELECT 'ibkr_events', 'row_count_stability', 'WARN', CAST(rows AS VARCHAR) FROM n
    UNION ALL SELECT 'ibkr_events', 'freshness', 'WARN', date_diff('day', date_trunc('day', newest), TIMESTAMP '2030-01-01') - CASE
      WHEN date_trunc('day', newest) = newest THEN 0 ELSE 1 END || ' days old' FROM n
    UNION ALL SELECT 'ibkr_events', 'non_empty', 'PASS', CAST(rows AS VARCHAR) FROM n""",
)
def _(spark, d):
    rows = _holed(spark, d).withColumn("event_id", F.nullif("event_id", F.lit("1")))
    sealed = rows.withColumns({c: F.col(c).cast("string") for c in EVENTS_MONEY if c in rows.columns})
    table = conform(sealed, EVENTS)
    now = datetime(2030, 1, 1, tzinfo=UTC)
    checks = table_checks("ibkr_events", table, previous=10**12, now=now, must_have_rows=True)
    results = results_frame(spark, [("ibkr_events", c) for c in checks], now)
    return results.select("table_name", "check_name", "status", "actual")


def _history(spark, d) -> DataFrame:
    """Events as a history of quality results."""
    return L.table(spark, d, "events").selectExpr(
        "ts AS checked_at", "concat('t', user_id % 10) AS table_name",
        "CASE WHEN event_id % 2 = 0 THEN 'row_count_stability' ELSE 'schema' END AS check_name",
        "CASE WHEN event_type = 'error' THEN 'FAIL' WHEN event_type = 'view' THEN 'WARN' ELSE 'PASS' END AS status",
        "CASE WHEN event_id % 10 = 4 THEN 'n/a' ELSE CAST(event_id AS STRING) END AS actual",
    )


@register(
    "dq_previous_counts",
    """SELECT 't' || (user_id % 10) AS table_name, CASE WHEN event_id % 10 = 4 THEN NULL ELSE event_id END AS previous FROM events
    WHERE event_id % 2 = 0 AND event_type <> 'error'
    QUALIFY row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts DESC) = 1""",
)
def _(spark, d):
    return previous_counts(_history(spark, d))


@register(
    "dq_status_counts",
    """SELECT CASE WHEN event_type = 'error' THEN 'FAIL' WHEN event_type = 'view' THEN 'WARN' ELSE 'PASS' END AS status,
      count(*) AS checks FROM events GROUP BY 1""",
)
def _(spark, d):
    return R.status_counts(_history(spark, d))


@register(
    "report_section_visibility",
    """WITH q AS (SELECT CASE user_id % 4 WHEN 0 THEN 'portfolio' WHEN 3 THEN 'cash_flow' ELSE 'passive_income' END AS section,
      count(*) AS rows, count(*) FILTER (WHERE event_type = 'error' AND user_id % 4 <> 3) AS fails FROM events GROUP BY 1)
    SELECT section, rows > 0 AND fails = 0 AS visible FROM q""",
)
def _(spark, d):
    table = F.expr(
        "CASE user_id % 4 WHEN 0 THEN 'portfolio_holdings' WHEN 1 THEN 'dividend_income' WHEN 2 THEN 'interest_income' "
        "ELSE 'cash_flow_summary' END"
    )
    rows = L.table(spark, d, "events").select(
        table.alias("table_name"), F.expr("IF(event_type = 'error' AND user_id % 4 <> 3, 'FAIL', 'PASS')").alias("status")
    )
    counts = rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))
    return R.section_visibility(counts, rows)


# ================================================================ joins of the mappings


@register(
    "closed_position_fee_join",
    """WITH closed AS (SELECT l_orderkey, l_linenumber, l_tax, l_shipdate FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_tax DESC, l_shipdate DESC) = 1)
    SELECT o_orderkey, n.l_linenumber, l_tax AS fee, strftime(l_shipdate, '%Y-%m-%d') AS closed_on
    FROM (SELECT o_orderkey, 1 AS l_linenumber FROM orders UNION ALL SELECT o_orderkey, 2 FROM orders) n
    LEFT JOIN closed c ON c.l_orderkey = n.o_orderkey AND c.l_linenumber = n.l_linenumber""",
)
def _(spark, d):
    operations = L.table(spark, d, "orders").selectExpr("o_orderkey", "explode(array(1, 2)) AS l_linenumber")
    closed = L.table(spark, d, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_linenumber", "l_tax AS fee", "date_format(l_shipdate, 'yyyy-MM-dd') AS closed_on",
        "struct(l_partkey, l_suppkey, l_extendedprice, l_quantity, l_tax, l_shipdate) AS row_idx",
    )
    return xtb.enrich_closings(operations, closed, ["o_orderkey", "l_linenumber"], "row_idx")


@register(
    "workbook_header_detect",
    """WITH h AS (SELECT l_orderkey, min(l_linenumber) AS header_idx FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, h.header_idx FROM lineitem l JOIN h ON h.l_orderkey = l.l_orderkey
    WHERE l.l_linenumber > h.header_idx""",
)
def _(spark, d):
    rows = L.table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "IF(l_returnflag = 'R', array(' Type', 'Instrument  '), array(l_returnflag, l_linestatus)) AS cells",
    )
    return locate_body(rows, ["l_orderkey"], header_is(F.col("cells"), "type", "instrument"), "l_linenumber").drop("cells")


@register(
    "json_tax_split",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) * CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS fee,
      CASE WHEN event_id % 3 = 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tax FROM events""",
)
def _(spark, d):
    amount = F.get_json_object("props", "$.k").cast("double")

    def entry(name: F.Column) -> F.Column:
        return F.struct(name.alias("name"), (-amount).alias("quantity"))

    fee, other = F.lit("PTM_LEVY"), F.lit("SOMETHING")
    taxes = F.array(
        entry(F.lit("STAMP_DUTY")),
        entry(F.when(F.col("event_id") % 2 == 0, fee).otherwise(other)),
        entry(F.when(F.col("event_id") % 3 == 0, F.lit("FRENCH_TRANSACTION_TAX")).otherwise(other)),
    )
    pages = L.dealt(L.table(spark, d, "events")).select("event_id", F.to_json(taxes).alias("page"))
    parsed = pages.select("event_id", F.from_json("page", trading212.TAXES_JSON).alias("taxes"))
    return parsed.select(
        "event_id", trading212.tax_sum(F.col("taxes"), trading212.FEE_NAMES).alias("fee"),
        trading212.tax_sum(F.col("taxes"), trading212.TAX_NAMES).alias("tax"),
    )


@register(
    "json_page_unwrap",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 4 < 2""",
)
def _(spark, d):
    rows = L.table(spark, d, "events").selectExpr(
        "ts AS fetched_at", "'Trading 212' AS broker", "'/equity/history/orders' AS source", "event_id",
        "CAST(CASE event_id % 4 WHEN 0 THEN concat('[', props, ']') WHEN 1 THEN concat('{\"items\":[', props, ']}') "
        "WHEN 2 THEN concat(props, '}') ELSE props END AS BINARY) AS payload",
    )
    return explode_events(decode_rows(rows, None), "struct<k:bigint>").select("event_id", "item.k")


@register(
    "account_base_currency",
    """SELECT o_orderkey, 'U' || (o_custkey % 50) AS account_id, CASE WHEN o_custkey % 2 = 0 THEN 'EUR' ELSE 'USD' END AS base_ccy
    FROM orders""",
)
def _(spark, d):
    elements = ibkr.event_elements(L.ibkr_fees(spark, d))
    key = F.regexp_extract("_taxDescription", r"(\d+)", 1).cast("bigint")
    return elements.select(key.alias("o_orderkey"), F.col("_accountId").alias("account_id"), "base_ccy")


@register(
    "synthetic_opening_deposit",
    f"""WITH {L.LEDGER_SQL}, first AS (SELECT date_trunc('day', min(fetched_at)) - INTERVAL 1 DAY AS day FROM ledger),
    a AS (SELECT account_id, min(security_ccy) AS base_ccy FROM ledger GROUP BY account_id)
    SELECT account_id, substr(sha256('CashTransaction|' || account_id || '|PAPER_INITIAL_DEPOSIT'), 1, 16) AS event_id,
      strftime(day, '%Y-%m-%dT%H:%M:%SZ') AS event_datetime, strftime(day, '%Y-%m-%d') AS settle_date, base_ccy AS security_ccy,
      CAST(1000000 AS DOUBLE) AS cash_amount, CASE WHEN base_ccy = 'EUR' THEN CAST(1 AS DOUBLE) END AS target_fx_rate FROM a, first""",
)
def _(spark, d):
    events = L.ledger(spark, d).withColumn("event_datetime", V.iso_datetime("event_datetime"))
    accounts = events.groupBy("account_id").agg(F.min("security_ccy").alias("base_ccy"), F.max("fetched_at").alias("fetched_at"))
    return ibkr.opening_deposits(events, accounts).select(
        "account_id", "event_id", "event_datetime", "settle_date", "security_ccy", "cash_amount", "target_fx_rate"
    )


# ================================================================ crypto


@register(
    "crypto_roundtrip",
    "SELECT c_custkey, c_acctbal, c_name, CAST(NULL AS DOUBLE) AS nothing FROM customer",
)
def _(spark, d):
    rows = L.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_name", F.lit(None).cast("double").alias("nothing"))
    sealed = fernet.encrypt_columns(rows, ["c_acctbal", "nothing"], L.DEMO_KEY)
    return fernet.decrypt_columns(sealed, ["c_acctbal", "nothing"], L.DEMO_KEY)


@register("crypto_payload_roundtrip", "SELECT doc_id, sha256(text) AS digest FROM documents")
def _(spark, d):
    rows = L.table(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("payload"))
    opened = fernet.decrypt_payload(fernet.encrypt_payload(rows, L.DEMO_KEY), L.DEMO_KEY, strict=True)
    return opened.select("doc_id", F.sha2("payload", 256).alias("digest"))


@register(
    "crypto_decrypt_all",
    """SELECT c_custkey, c_acctbal AS money, c_name AS name,
      CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) WHEN c_custkey % 3 = 1 THEN c_name ELSE '7x' END AS mixed FROM customer""",
)
def _(spark, d):
    mixed = F.expr("CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS STRING) WHEN 1 THEN c_name ELSE '7x' END")
    rows = L.table(spark, d, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("money"), F.col("c_name").alias("name"), mixed.alias("mixed")
    )
    sealed = fernet.seal(fernet.encrypt_columns(rows, ["money"], L.DEMO_KEY), ["name", "mixed"], L.DEMO_KEY)
    return fernet.decrypt_all(sealed, L.DEMO_KEY)


@register(
    "crypto_lenient_decode",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE c_custkey % 3 <> 0) AS readable FROM customer""",
)
def _(spark, d):
    rows = L.table(spark, d, "customer").select("c_custkey", F.col("c_name").cast("binary").alias("payload"))
    sealed = fernet.encrypt_payload(rows, L.DEMO_KEY)
    broken = sealed.withColumn(
        "payload", F.when(F.col("c_custkey") % 3 == 0, F.expr("substring(payload, 5)")).otherwise(F.col("payload"))
    )
    opened = fernet.decrypt_payload(broken, L.DEMO_KEY)
    return opened.agg(F.count(F.lit(1)).alias("rows"), F.count("payload").alias("readable"))


# ================================================================ broker payloads

_EVENT_OUT = ("account_id", "event_id", "event_type", "raw_event_type", "event_datetime", "security_ccy", "cash_amount",
              "settle_date", "ticker", "quantity", "price", "side", "fee_amount", "target_fx_rate")


def _ibkr_out(raw: DataFrame) -> DataFrame:
    return ibkr.map_elements(ibkr.event_elements(raw), L.TARGET).select(*_EVENT_OUT)


_DAY = "strftime(o_orderdate, '%Y-%m-%dT00:00:00Z')"
_MOMENT = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')"
_FX = "CASE WHEN base_ccy = 'EUR' THEN fx END AS target_fx_rate"


def _hash_sql(*parts: str) -> str:
    return "substr(sha256(" + " || '|' || ".join(parts) + "), 1, 16)"


@register(
    "ibkr_trade_events",
    f"""WITH {L.ORDER_SQL} SELECT account_id, CASE WHEN o_orderkey % 6 < 3 THEN 'e' || o_orderkey
      WHEN o_orderkey % 6 = 3 THEN 't' || o_orderkey
      ELSE {_hash_sql("'Trade'", "account_id", "strftime(o_orderdate, '%Y%m%d;%H%M%S')", "o_orderpriority", "CAST(o_custkey AS VARCHAR)")}
      END AS event_id, 'TRADE' AS event_type, 'ExTrade' AS raw_event_type, {_MOMENT} AS event_datetime, ccy AS security_ccy,
      -o_totalprice AS cash_amount, {_DAY} AS settle_date, o_orderpriority AS ticker, CAST(o_custkey AS DOUBLE) AS quantity,
      o_totalprice AS price, CASE WHEN o_orderstatus = 'F' THEN 'SELL' ELSE 'BUY' END AS side,
      CASE WHEN o_orderkey % 5 <> 0 AND ccy <> 'EUR' AND base_ccy = 'EUR' THEN ((o_orderkey % 7) + CAST(0.25 AS DOUBLE)) / fx
        ELSE (o_orderkey % 7) + CAST(0.25 AS DOUBLE) END AS fee_amount, {_FX} FROM o""",
)
def _(spark, d):
    return _ibkr_out(L.ibkr_trades(spark, d))


@register(
    "ibkr_cash_events",
    f"""WITH {L.ORDER_SQL} SELECT account_id, 'c' || o_orderkey AS event_id,
      CASE o_orderkey % 7 WHEN 0 THEN 'DIVIDEND' WHEN 1 THEN 'TAX' WHEN 2 THEN 'INTEREST' WHEN 3 THEN 'FEE'
        WHEN 4 THEN CASE WHEN o_custkey % 3 = 0 THEN 'WITHDRAWAL' ELSE 'DEPOSIT' END WHEN 5 THEN 'ADJUSTMENT' ELSE 'UNKNOWN' END AS event_type,
      CASE o_orderkey % 7 {' '.join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(L.CASH_TYPE_CYCLE))} END AS raw_event_type,
      {_DAY} AS event_datetime, ccy AS security_ccy, CASE WHEN o_custkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END AS cash_amount,
      {_DAY} AS settle_date, o_orderpriority AS ticker, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS DOUBLE) AS price,
      CAST(NULL AS VARCHAR) AS side, CAST(NULL AS DOUBLE) AS fee_amount, {_FX} FROM o""",
)
def _(spark, d):
    return _ibkr_out(L.ibkr_cash(spark, d))


@register(
    "ibkr_transfer_events",
    f"""WITH {L.ORDER_SQL} SELECT account_id, CASE WHEN o_orderkey % 4 = 0
      THEN {_hash_sql("'Transfer'", "account_id", "strftime(o_orderdate, '%Y%m%d;%H%M%S')", "o_orderpriority", "CAST(o_custkey AS VARCHAR)")}
      ELSE 'r' || o_orderkey END AS event_id, 'TRANSFER' AS event_type, 'ACATS' AS raw_event_type, {_MOMENT} AS event_datetime,
      ccy AS security_ccy, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE CAST(0 AS DOUBLE) END AS cash_amount, {_DAY} AS settle_date,
      o_orderpriority AS ticker, CAST(o_custkey AS DOUBLE) AS quantity, o_totalprice AS price,
      CASE WHEN o_orderstatus = 'F' THEN 'OUT' ELSE 'IN' END AS side, CAST(NULL AS DOUBLE) AS fee_amount, {_FX} FROM o""",
)
def _(spark, d):
    return _ibkr_out(L.ibkr_transfers(spark, d))


@register(
    "ibkr_fee_events",
    f"""WITH {L.ORDER_SQL}, f AS (SELECT *, (o_orderkey % 100) / CAST(8 AS DOUBLE) AS amount FROM o)
    SELECT account_id, {_hash_sql("'TransactionFee'", "account_id", "strftime(o_orderdate, '%Y%m%d')", "'Fee ' || o_orderkey", "CAST(amount AS VARCHAR)")} AS event_id,
      'FEE' AS event_type, 'Fee ' || o_orderkey AS raw_event_type, {_DAY} AS event_datetime, ccy AS security_ccy, amount AS cash_amount,
      {_DAY} AS settle_date, o_orderpriority AS ticker, CAST(o_custkey AS DOUBLE) AS quantity, o_totalprice AS price,
      CAST(NULL AS VARCHAR) AS side, amount AS fee_amount, {_FX} FROM f""",
)
def _(spark, d):
    return _ibkr_out(L.ibkr_fees(spark, d))


@register(
    "ibkr_snapshot",
    """WITH p AS (SELECT *, 'U' || c_custkey AS account_id,
      CASE WHEN c_custkey % 4 = 0 THEN c_nationkey * CAST(2.5 AS DOUBLE) ELSE c_acctbal END AS v FROM customer)
    SELECT account_id, 'EQUITY' AS position_type, CASE WHEN c_custkey % 7 = 0 THEN c_name ELSE c_mktsegment END AS label,
      'STK' AS asset_class, v AS security_value, 'USD' AS security_ccy,
      CASE WHEN c_custkey % 2 = 0 THEN 'US0378331005' ELSE '' END AS isin, c_name AS description FROM p WHERE v <> 0
    UNION ALL
    SELECT account_id, 'CASH', 'CASH ' || ccy, 'CASH', c_acctbal, ccy, '', 'Cash ' || ccy
    FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'PLN' ELSE 'EUR' END AS ccy FROM p) WHERE c_acctbal <> 0""",
)
def _(spark, d):
    return ibkr.snapshot(L.ibkr_statements(spark, d)).drop("fetched_at")


@register(
    "ibkr_conversion_rates",
    """SELECT 'USD' AS ccy, c_nationkey / CAST(8 AS DOUBLE) AS rate, count(*) AS statements FROM customer
    WHERE c_custkey % 6 <> 0 AND c_nationkey <> 0 GROUP BY c_nationkey""",
)
def _(spark, d):
    rates = conversion_rates(L.ibkr_statements(spark, d), "flex", None)
    return rates.groupBy("ccy", "rate").agg(F.count(F.lit(1)).alias("statements"))


@register(
    "ibkr_paper_deposits",
    """WITH newest AS (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 1),
    day AS (SELECT min(o_orderdate) - INTERVAL 1 DAY AS day FROM orders)
    SELECT 'U' || (o_custkey % 50) AS account_id, CASE WHEN o_custkey % 2 = 0 THEN 'EUR' ELSE 'USD' END AS security_ccy,
      strftime(date_trunc('day', day), '%Y-%m-%dT%H:%M:%SZ') AS event_datetime, CAST(1000000 AS DOUBLE) AS cash_amount FROM newest, day""",
)
def _(spark, d):
    raw = L.raw_from(
        L.table(spark, d, "orders"), "IBKR", "'flex_events'",
        L.statement(L.ACCOUNT, L.BASE, "CashTransactions", "CashTransaction",
                    {"dateTime": L.COMPACT, "amount": "'1'", "transactionID": "concat('c', o_orderkey)"}),
        "timestamp_seconds(o_orderkey)",
    )
    rows = ibkr.events(raw, is_paper=True, target=L.TARGET).filter("description = 'Initial paper account deposit'")
    return rows.select("account_id", "security_ccy", "event_datetime", "cash_amount")


@register(
    "trading212_order_events",
    """WITH o AS (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN CAST(0.25 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS fx,
        CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice ELSE o_totalprice / CAST(2 AS DOUBLE) END AS net FROM orders)
    SELECT CAST(o_orderkey AS VARCHAR) AS event_id, 'TRADE' AS event_type, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS event_datetime,
      CASE WHEN o_orderkey % 3 = 0 THEN 'EUR' ELSE 'USD' END AS security_ccy,
      net * fx * CASE WHEN o_orderstatus = 'O' THEN CAST(-1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS cash_amount,
      CASE WHEN o_orderkey % 5 = 0 THEN 'I_EQ' ELSE o_orderpriority END AS ticker, CAST(o_custkey AS DOUBLE) AS quantity,
      o_totalprice / CAST(4 AS DOUBLE) AS price, CASE o_orderstatus WHEN 'F' THEN 'SELL' WHEN 'O' THEN 'BUY' END AS side,
      ((o_orderkey % 9) / CAST(4 AS DOUBLE) + (o_orderkey % 5) / CAST(2 AS DOUBLE)) * fx AS fee_amount,
      o_custkey / CAST(8 AS DOUBLE) * fx AS tax_amount FROM o""",
)
def _(spark, d):
    return trading212.events(L.trading212_orders(spark, d)).select(
        "event_id", "event_type", "event_datetime", "security_ccy", "cash_amount", "ticker", "quantity", "price", "side",
        "fee_amount", "tax_amount",
    )


@register(
    "trading212_dividend_events",
    """SELECT 'd' || o_orderkey AS event_id, CASE WHEN o_orderkey % 3 = 0 THEN 'DIVIDEND' ELSE 'ORDINARY' END AS raw_event_type,
      strftime(o_orderdate, '%Y-%m-%d') AS settle_date,
      CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'EUR' ELSE 'USD' END ELSE 'EUR' END AS security_ccy,
      CASE WHEN o_orderkey % 5 = 0 THEN 'EUR' ELSE 'USD' END AS instrument_ccy, o_totalprice AS cash_amount, o_orderpriority AS ticker,
      CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice / CAST(8 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS price FROM orders""",
)
def _(spark, d):
    return trading212.events(L.trading212_dividends(spark, d)).select(
        "event_id", "raw_event_type", "settle_date", "security_ccy", "instrument_ccy", "cash_amount", "ticker", "price"
    )


@register(
    "trading212_all_events",
    """SELECT 'TRADE' AS event_type, count(*) AS events, count(DISTINCT o_orderkey) AS ids FROM orders
    UNION ALL SELECT 'DIVIDEND', count(*), count(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT CASE o_orderkey % 5 WHEN 0 THEN 'WITHDRAWAL' WHEN 1 THEN 'DEPOSIT' WHEN 2 THEN 'FEE' WHEN 3 THEN 'TRANSFER'
      ELSE 'UNKNOWN' END, count(*), count(DISTINCT o_orderkey) FROM orders GROUP BY 1""",
)
def _(spark, d):
    pages = L.trading212_orders(spark, d).unionByName(L.trading212_dividends(spark, d)).unionByName(L.trading212_transactions(spark, d))
    return trading212.events(pages).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids")
    )


@register(
    "trading212_dividend_mismatches",
    "SELECT count(*) FILTER (WHERE o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0) AS mismatches FROM orders",
)
def _(spark, d):
    return trading212.currency_mismatches(decode_rows(L.trading212_dividends(spark, d), None))


@register(
    "trading212_transaction_events",
    """SELECT 'x' || o_orderkey AS event_id, CASE o_orderkey % 5 WHEN 0 THEN 'WITHDRAWAL' WHEN 1 THEN 'DEPOSIT' WHEN 2 THEN 'FEE'
      WHEN 3 THEN 'TRANSFER' ELSE 'UNKNOWN' END AS event_type,
      CASE WHEN o_orderkey % 5 = 0 THEN -o_totalprice ELSE o_totalprice END AS cash_amount, 'PLN' AS security_ccy,
      CAST(0 AS DOUBLE) AS price, '' AS ticker FROM orders""",
)
def _(spark, d):
    return trading212.events(L.trading212_transactions(spark, d)).select(
        "event_id", "event_type", "cash_amount", "security_ccy", "price", "ticker"
    )


@register(
    "trading212_snapshot",
    """WITH newest AS (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
    SELECT 'EQUITY' AS position_type, o_orderpriority AS label, o_totalprice * o_custkey AS security_value, 'USD' AS security_ccy FROM newest
    UNION ALL SELECT 'EQUITY', o_orderpriority || '2', CAST(7 AS DOUBLE) * o_custkey, 'EUR' FROM newest
    UNION ALL SELECT 'CASH', 'CASH PLN', o_totalprice, 'PLN' FROM newest""",
)
def _(spark, d):
    orders = L.table(spark, d, "orders")
    # the fetch time orders the pages; the key breaks ties between pages of one day
    when = "timestampadd(MICROSECOND, o_orderkey, CAST(o_orderdate AS TIMESTAMP))"
    summary = L.raw_from(
        orders, "Trading 212", "'/equity/account/summary'",
        "to_json(named_struct('currency', 'PLN', 'cash', named_struct('availableToTrade', o_totalprice)))", when,
    )
    positions = L.raw_from(
        orders, "Trading 212", "'/equity/positions'",
        "to_json(array(named_struct('instrument', named_struct('ticker', o_orderpriority, 'name', 'N', 'isin', 'X', 'currency', 'USD'), "
        "'quantity', o_custkey, 'currentPrice', o_totalprice), "
        "named_struct('instrument', named_struct('ticker', 'NONE', 'name', 'N', 'isin', 'X', 'currency', 'USD'), 'quantity', 0, "
        "'currentPrice', CAST(1 AS DOUBLE)), "
        "named_struct('instrument', named_struct('ticker', concat(o_orderpriority, '2'), 'name', 'N', 'isin', 'X', 'currency', 'EUR'), "
        "'quantity', o_custkey, 'currentPrice', CAST(7 AS DOUBLE))))", when,
    )
    rows = trading212.snapshot(summary.unionByName(positions))
    return rows.select("position_type", "label", "security_value", "security_ccy")


@register(
    "xtb_snapshot",
    """WITH c AS (SELECT CAST(10000000 + c_custkey AS VARCHAR) AS account_id, CASE WHEN c_custkey % 2 = 1 THEN 'PLN' ELSE 'EUR' END AS ccy, * FROM customer)
    SELECT account_id, 'EQUITY' AS position_type, c_mktsegment || '.DE' AS label, 'ETF' AS asset_class, c_acctbal AS security_value,
      ccy AS security_ccy, c_name AS description FROM c WHERE c_acctbal <> 0
    UNION ALL SELECT account_id, 'CASH', 'CASH ' || ccy, 'CASH', c_acctbal, ccy, 'Cash ' || ccy FROM c""",
)
def _(spark, d):
    return xtb.snapshot(L.customer_workbooks(spark, d)).drop("fetched_at", "isin")


@register(
    "xtb_events",
    """WITH c AS (SELECT CAST(10000000 + c_custkey AS VARCHAR) AS account_id, CASE WHEN c_custkey % 2 = 1 THEN 'PLN' ELSE 'EUR' END AS ccy, * FROM customer)
    SELECT account_id, CAST(10 * c_custkey + 1 AS VARCHAR) AS event_id, 'DEPOSIT' AS event_type, ccy AS security_ccy, c_acctbal AS cash_amount,
      '2025-12-09T12:00:00+00:00' AS event_datetime, '' AS ticker, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS DOUBLE) AS price,
      CAST(NULL AS VARCHAR) AS side, CAST(NULL AS DOUBLE) AS fee_amount, CAST(NULL AS VARCHAR) AS settle_date FROM c
    UNION ALL SELECT account_id, CAST(10 * c_custkey + 3 AS VARCHAR), 'TRADE', ccy, CAST(1234.5 AS DOUBLE), '2025-12-11T06:00:00+00:00', 'WDG.DE',
      (c_custkey % 9) + CAST(1.5 AS DOUBLE), CAST(12.25 AS DOUBLE), 'BUY',
      round_even((c_custkey % 50) / CAST(4 AS DOUBLE), 2), '2026-08-02T06:00:00+00:00' FROM c
    UNION ALL SELECT account_id, CAST(10 * c_custkey + 4 AS VARCHAR), 'TAX', ccy, CAST(-0.25 AS DOUBLE), '2025-12-12T00:00:00+00:00', '',
      NULL, NULL, NULL, NULL, NULL FROM c""",
)
def _(spark, d):
    return xtb.events(L.customer_workbooks(spark, d)).select(
        "account_id", "event_id", "event_type", "security_ccy", "cash_amount", "event_datetime", "ticker", "quantity", "price",
        "side", "fee_amount", "settle_date",
    )


def _two_uploads(spark, d) -> DataFrame:
    """Raw rows with a second upload per account, unreadable for every third of them."""
    first = L.customer_workbooks(spark, d).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))
    broken = F.col("payload_hash").cast("bigint") % 3 == 0
    second = first.withColumns(
        {
            "fetched_at": F.lit("2024-01-02").cast("timestamp"),
            "payload": F.when(broken, F.lit(b"not a workbook")).otherwise(F.col("payload")),
        }
    )
    return first.unionByName(second)


@register(
    "xtb_report_notes",
    """SELECT count(*) FILTER (WHERE c_custkey % 3 = 0) AS unusable_reports, CAST(0 AS BIGINT) AS dropped_cash_rows,
      CAST(0 AS BIGINT) AS account_mismatches FROM customer""",
)
def _(spark, d):
    return xtb.report_notes(xtb.parsed_reports(_two_uploads(spark, d)))


@register(
    "xtb_latest_report_fallback",
    "SELECT CAST(10000000 + c_custkey AS VARCHAR) AS account_id, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS upload FROM customer",
)
def _(spark, d):
    return xtb.latest_reports(_two_uploads(spark, d)).facts.select("account_id", F.dayofmonth("fetched_at").alias("upload"))


@register(
    "xtb_reports_by_rank",
    """SELECT CAST(10000000 + c_custkey AS VARCHAR) AS account_id,
      CAST(CASE WHEN c_custkey % 2 = 0 THEN 4 WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS reports_read,
      CASE WHEN c_custkey % 6 = 0 THEN 2 WHEN c_custkey % 3 = 0 THEN 4 WHEN c_custkey % 2 = 0 THEN 3 ELSE 5 END AS upload FROM customer""",
)
def _(spark, d):
    """Five uploads: the newest are unreadable for a half and a third of the accounts, more of them for a sixth."""
    books, key = L.customer_workbooks(spark, d), F.col("payload_hash").cast("bigint")
    days = books.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(5))))
    readable_up_to = F.when(key % 6 == 0, 2).when(key % 3 == 0, 4).when(key % 2 == 0, 3).otherwise(5)
    raw = days.withColumns(
        {
            "fetched_at": F.timestamp_add("DAY", F.col("day"), F.lit("2023-12-31").cast("timestamp")),
            "payload": F.when(F.col("day") > readable_up_to, F.lit(b"not a workbook")).otherwise(F.col("payload")),
        }
    )
    found = xtb.latest_reports(raw.drop("day"))
    read = found.tried.groupBy("file_account").agg(F.count("*").alias("reports_read"))
    return found.facts.join(read, "file_account").select("account_id", "reports_read", F.dayofmonth("fetched_at").alias("upload"))


@register(
    "workbook_cells",
    """SELECT CAST(c_custkey AS VARCHAR) AS payload_hash, 'cash operation' AS sheet, '1 234,50' AS sixth,
      'CLOSE BUY ' || (c_custkey % 9 + 1) || '.5 @ 12.25' AS eighth, CAST(500 + c_custkey AS VARCHAR) AS tenth FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'open position', '1', NULL, NULL FROM customer""",
)
def _(spark, d):
    raw = L.customer_workbooks(spark, d).select("payload_hash", F.col("payload").alias("body"))
    long = sheet_rows(raw)
    at = lambda i: F.get("cells", F.lit(i))
    sold, held = at(0) == "Stock sell", (at(3) == "ETF") & (F.col("sheet") == "open position") & (at(1) != "Sold")
    return long.filter(sold | held).select(
        "payload_hash", "sheet", at(5).alias("sixth"), at(7).alias("eighth"), at(9).alias("tenth")
    )
