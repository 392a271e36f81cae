"""XTB: workbook reports to snapshot rows and events."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.brokers.base import Broker
from tally.functions.fernet import Key
from tally.functions.values import account_from_file_name, excel_timestamp, iso_offset_text, lookup, trade_comment
from tally.operators.dedup import XTB_EVENT_KEY, dedup_newest, keep_first
from tally.operators.shaping import conform
from tally.schemas import BROKER_NAMES, EVENTS, SNAPSHOT, plain
from tally.sources.json_payloads import decode_rows
from tally.sources.landing import XTB_REPORT
from tally.sources.scratch import Scratch
from tally.sources.workbook import (
    closed_positions, operations, positions, sheet_rows, typed_rows, with_amounts, workbook_facts,
)

# --- fixed values: operation types ---
OPERATION_TYPES = {
    "Free funds interest": "INTEREST",
    "Free funds interest tax": "TAX",
    "Stock purchase": "TRADE",
    "Stock sell": "TRADE",
    "Open position": "TRADE",
    "Close position": "TRADE",
    "Transfer": "TRANSFER",
    "Deposit": "DEPOSIT",
    "Withdrawal": "WITHDRAWAL",
    "Dividend": "DIVIDEND",
    "Fee": "FEE",
    "Correction": "ADJUSTMENT",
    "Profit/loss adjustment": "ADJUSTMENT",
}
TRADE_TYPES = ("Stock sell", "Stock purchase", "Open position", "Close position")
CLOSING_TYPES = ("Stock sell", "Close position")

_NAME = BROKER_NAMES["xtb"]


def classify_operation(kind: Column) -> Column:
    return lookup(OPERATION_TYPES, kind, "UNKNOWN")


@dataclass(frozen=True)
class Reports:
    """Reports that were read: one row each in ``facts``, and their typed rows.

    ``rows`` and ``facts`` are connected by ``report``. ``tried`` has the facts of every report that was read on the
    way, of the later ones those that could not be used included.
    """

    rows: DataFrame
    facts: DataFrame
    tried: DataFrame


_NEWEST = ("fetched_at", "source_file", "payload_hash")


def _named(raw: DataFrame) -> DataFrame:
    """The report rows with ``report``, one id per time, file and content."""
    rows = raw.filter(F.col("source") == XTB_REPORT).withColumn("source_file", F.coalesce("source_file", F.lit("")))
    identity = F.sha2(F.to_json(F.struct(F.unix_micros("fetched_at").alias("t"), "source_file", "payload_hash")), 256)
    return rows.withColumn("report", identity)


def _heads(named: DataFrame) -> DataFrame:
    """One narrow row per report; the account is the one in the file name, null where there is none."""
    account = account_from_file_name("source_file").alias("file_account")
    return named.select("report", "fetched_at", "source", "source_file", "payload_hash", account).distinct()


def _read(named: DataFrame, heads: DataFrame, key: Key | None, scratch: Scratch) -> Reports:
    """The reports of ``heads``, parsed once: their rows and facts are written and read back."""
    wanted = named.join(heads.select("report"), "report", "left_semi").dropDuplicates(["report"])
    books = decode_rows(wanted, key, require_json=False).select("report", "body")
    typed = scratch.written(typed_rows(sheet_rows(books)), "report-rows")
    found = heads.join(workbook_facts(typed, "report"), "report", "left").fillna({"ok": False, "account_id": "", "dropped_rows": 0})
    facts = scratch.written(found, "report-facts")
    return Reports(typed, facts, facts)


def parsed_reports(raw: DataFrame, key: Key | None = None, scratch: Scratch | None = None) -> Reports:
    """All reports; one that cannot be decrypted or read is not ``ok``."""
    scratch = scratch or Scratch(raw.sparkSession)
    named = _named(raw)
    return _read(named, scratch.written(_heads(named), "report-heads"), key, scratch)


def _account() -> Column:
    return F.coalesce("file_account", F.nullif(F.col("account_id"), F.lit("")))


def _ranked(heads: DataFrame, above: int, up_to: int) -> DataFrame:
    """Each account's reports from one place of age to another, the newest being the first."""
    order = Window.partitionBy("file_account").orderBy(*[F.col(c).desc() for c in _NEWEST])
    return heads.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= up_to).filter(F.col("rank") > above).drop("rank")


def latest_reports(raw: DataFrame, key: Key | None = None, scratch: Scratch | None = None) -> Reports:
    """Newest usable report per account.

    The account is read from the file name, else from the report; a report that cannot be used gives way to the
    account's next older one, and an account without any is left out.

    Only what is needed is parsed: the newest report of every account, then, for accounts that have none to use yet,
    the next one, the next two, the next four and so on. A round reads payloads of its reports only, ranked by narrow
    rows; reports whose file name tells no account are read in the first round. Each round is written and read back.
    """
    scratch = scratch or Scratch(raw.sparkSession)
    named = _named(raw)
    heads = scratch.written(_heads(named), "report-heads")
    told = heads.filter(F.col("file_account").isNotNull())
    reach, rounds = 1, []
    wanted = _ranked(told, 0, reach).unionByName(heads.filter(F.col("file_account").isNull()))
    while True:
        rounds.append(_read(named, wanted, key, scratch))
        tried = reduce(DataFrame.unionByName, [r.tried for r in rounds])
        settled = tried.filter("ok AND file_account IS NOT NULL").select("file_account").distinct()
        wanted = _ranked(told.join(settled, "file_account", "left_anti"), reach, 2 * reach)
        if wanted.isEmpty():
            break
        reach *= 2
    usable = tried.filter("ok").withColumn("account", _account()).filter(F.col("account").isNotNull())
    latest = keep_first(usable, ["account"], [F.col(c).desc() for c in _NEWEST]).drop("account")
    return Reports(reduce(DataFrame.unionByName, [r.rows for r in rounds]), latest, tried)


def report_notes(reports: Reports) -> DataFrame:
    """What a run should warn about: unusable reports, dropped rows, account mismatches among what was read."""
    return reports.tried.agg(
        F.count_if(~F.col("ok")).alias("unusable_reports"),
        F.coalesce(F.sum("dropped_rows"), F.lit(0)).alias("dropped_cash_rows"),
        F.count_if((F.col("account_id") != "") & (F.col("file_account") != F.col("account_id"))).alias("account_mismatches"),
    )


def report_holdings(reports: Reports) -> DataFrame:
    """One row per open position worth something, and the free cash of reports that state it (0 included)."""
    equity = {"position_type": F.lit("EQUITY"), "label": F.col("ticker"), "asset_class": F.col("category"), "value_text": F.coalesce("value", F.lit("0")), "description": F.col("instrument")}
    cash = {"position_type": F.lit("CASH"), "label": F.concat(F.lit("CASH "), "account_ccy"), "asset_class": F.lit("CASH"), "value_text": F.col("free_cash"), "description": F.concat(F.lit("Cash "), "account_ccy")}
    own = reports.facts.select("report", "fetched_at", "account_id", "account_ccy", "free_cash")
    held = positions(reports.rows).join(own, "report")
    fields = lambda of: [F.col("fetched_at"), F.col("account_id"), F.col("account_ccy").alias("security_ccy"), F.lit("").alias("isin"), *[c.alias(n) for n, c in of.items()]]
    rows = held.select(*fields(equity)).unionByName(own.filter(F.col("free_cash").isNotNull()).select(*fields(cash)))
    valued = with_amounts(rows, security_value="value_text")
    kept = (F.col("position_type") == "CASH") | (F.col("security_value") != 0)
    return conform(valued.filter(kept), plain(SNAPSHOT))


def _reports(raw: DataFrame | Reports, key: Key | None) -> Reports:
    return raw if isinstance(raw, Reports) else latest_reports(raw, key)


def snapshot(raw: DataFrame | Reports, key: Key | None = None) -> DataFrame:
    """Holdings of the newest usable report per account; ``raw`` may be :func:`latest_reports` already."""
    return report_holdings(_reports(raw, key))


def enrich_closings(operations: DataFrame, closed: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Left join of operations with closed positions kept in a table of their own.

    Of several closed rows with the same key the last one counts. The right side
    is one row per key; a hot key on the left is split by the skew join.
    """
    last = keep_first(closed, keys, [F.col(order).desc()]).drop(order)
    return operations.join(last, keys, "left")


def operation_fields() -> dict[str, Column]:
    """Columns over the cells of an operation, ``amount_value``, ``fee``, ``at`` and ``closed_at``."""
    is_trade = F.col("type").isin(*TRADE_TYPES)
    parsed = {n: F.when(is_trade, c) for n, c in trade_comment("comment").items()}
    return {
        "event_id": F.col("id"),
        "event_type": classify_operation(F.col("type")),
        "raw_event_type": F.col("type"),
        "event_datetime": iso_offset_text("at"),
        "cash_amount": F.col("amount_value"),
        "settle_date": iso_offset_text("closed_at"),
        "ticker": F.when(is_trade, F.col("ticker")).otherwise(F.lit("")),
        "isin": F.lit(""),
        "description": F.col("comment"),
        **parsed,
        "fee_amount": F.col("fee"),
    }


def report_events(reports: Reports) -> DataFrame:
    """One event per cash operation; closing trades carry commission and close time.

    Of several closed rows of a position within a report the last one counts.
    """
    own = reports.facts.select("report", "fetched_at", "source", "account_id", "account_ccy")
    closed = closed_positions(reports.rows).select("report", "position", "row_idx", "close_time", F.coalesce("commission", F.lit("0")).alias("commission"))
    made = operations(reports.rows).select("report", "type", "ticker", "id", "comment", "time", "amount", "position")
    matched = enrich_closings(made.join(own, "report"), closed.join(own.select("report"), "report", "left_semi"), ["report", "position"], "row_idx")
    closing = F.col("type").isin(*CLOSING_TYPES)
    texts = matched.withColumns(
        {
            "amount_text": F.coalesce("amount", F.lit("0")),
            "fee_text": F.when(closing, F.col("commission")),
            "at": excel_timestamp("time"),
            "closed_at": excel_timestamp(F.when(closing, F.col("close_time"))),
        }
    )
    valued = with_amounts(texts, amount_value="amount_text", fee="fee_text")
    fixed = {"broker": F.lit(_NAME), "security_ccy": F.col("account_ccy")}
    mapped = [c.alias(n) for n, c in {**fixed, **operation_fields()}.items()]
    return conform(valued.select("fetched_at", "source", "account_id", *mapped), plain(EVENTS))


def unread_comments(events: DataFrame) -> DataFrame:
    """One row: trades whose comment did not have the expected form."""
    unread = F.col("raw_event_type").isin(*TRADE_TYPES) & F.col("quantity").isNull()
    return events.agg(F.count_if(unread).alias("unread_comments"))


def events(raw: DataFrame | Reports, key: Key | None = None) -> DataFrame:
    """Cash operations of the newest usable report per account; ``raw`` may be :func:`latest_reports` already."""
    return dedup_newest(report_events(_reports(raw, key)), XTB_EVENT_KEY)


BROKER = Broker("xtb", snapshot, events, prepare=latest_reports, notes=report_notes)
