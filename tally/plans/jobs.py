"""The ledger's jobs over a lake: ingest, transform, consolidate, analyse, validate."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tally.brokers import BROKERS, Broker
from tally.functions.fernet import Key, decrypt_columns, encrypt_columns, encrypt_payload
from tally.operators.currency import ConversionError, normalize_currency, rates_frame, require_convertible
from tally.operators.holdings import consolidate_holdings, portfolio_holdings
from tally.operators.income import income_base, income_tables, lacks_target, require_target, with_periods
from tally.operators.ledger import consolidate_events
from tally.operators.quality import (
    Check, exit_code, previous_counts, reconciliation_check, results_frame, select_tables, table_checks,
)
from tally.operators.shaping import conform, observed, union_all
from tally.schemas import (
    CASH_FLOW_SUMMARY, CHECKED_TABLES, CONSOLIDATED_HOLDINGS, DATA_QUALITY, DEFAULT_TARGET, DIVIDEND_INCOME,
    EVENTS, EVENTS_MONEY, FAIL, HOLDINGS_MONEY, INCOME_MONEY, INTEREST_INCOME, PORTFOLIO_HOLDINGS, RAW,
    SNAPSHOT, SNAPSHOT_MONEY, WARN,
)
from tally.sources.keys import KeyIndex, content_key, picked
from tally.sources.lake import Lake
from tally.sources.landing import require_sources
from tally.sources.scratch import Scratch

log = logging.getLogger(__name__)


class NoHoldingsError(RuntimeError):
    """No broker has a snapshot."""


@dataclass
class Ledger:
    """A lake with its key and settings."""

    lake: Lake
    key: Key
    target: str = DEFAULT_TARGET
    rates: DataFrame | Mapping[str, float] | None = None
    manual_rates: Mapping[str, float] | Iterable[str] = field(default_factory=dict)

    @property
    def spark(self):
        return self.lake.spark

    def rate_table(self) -> DataFrame:
        return rates_frame(self.spark, self.rates, self.manual_rates)


# ---------------------------------------------------------------- raw


def ingest_raw(ledger: Ledger, batch: DataFrame, name: str, hand_on: bool = True) -> DataFrame | None:
    """Encrypt a batch and append what is new; with ``hand_on``, return the whole encrypted batch.

    Tokens differ with every evaluation (random IV) and a landing directory may
    change, so the batch is written out once to the shared folder; the search
    for known content, the append and the caller read that copy, which survives
    lost executors. A batch that is handed on keeps rows that were already
    stored and lies there until the caller clears the lake's stash.
    """
    sealed = encrypt_payload(conform(batch, RAW), ledger.key)
    if hand_on:
        sealed = ledger.lake.stash(sealed, f"batch-{name}")
        append_new(ledger.lake, sealed, name)
        return sealed
    with ledger.lake.scratch() as scratch:
        append_new(ledger.lake, scratch.written(sealed, f"batch-{name}"), name)
    return None


def append_new(lake: Lake, batch: DataFrame, name: str) -> None:
    """Append the rows of a stored batch whose content the table does not hold yet.

    Only the batch's keys meet the index of known ones, once; the rows are then
    picked by the keys that are new, where they lie: payloads are shuffled only
    where a bit table can't tell a new key from a known one. Copies inside the
    batch all stay. When there is nothing to append, a table without rows is
    still created, and an existing one gets no files.
    """
    index = KeyIndex(lake, name)
    with lake.scratch() as scratch:
        keys = scratch.written(index.marked(batch), "batch-keys")
        fresh = keys.filter("fresh").select("key")
        if fresh.isEmpty():
            lake.create(RAW, "raw", name)
            return
        rows = picked(batch.withColumn("key", content_key()), keys).drop("key")
        with index.changing():
            lake.append(rows, "raw", name, indexed=True)
            index.add(fresh)


# ---------------------------------------------------------------- broker runs


_LAYERS: dict[str, tuple] = {"snapshot": (SNAPSHOT, SNAPSHOT_MONEY), "events": (EVENTS, EVENTS_MONEY)}


def transform_broker(
    ledger: Ledger, broker: Broker, current: Mapping[str, DataFrame] | None = None, **events_options
) -> list[str]:
    """Rebuild the broker's normalized tables; returns the layers that were written.

    The input is the current batch for brokers that use it, else the accumulated
    raw table. An absent or empty input leaves the old table in place.
    """
    with ledger.lake.scratch() as scratch:
        return _transform_layers(ledger, broker, current or {}, scratch, events_options)


def _transform_layers(
    ledger: Ledger, broker: Broker, current: Mapping[str, DataFrame], scratch: Scratch, events_options: Mapping,
) -> list[str]:
    written, prepared = [], None
    for layer, (schema, money) in _LAYERS.items():
        handed = current.get(layer) if broker.uses_current_batch else None
        raw = handed if handed is not None else ledger.lake.find("raw", broker.name)
        if raw is None or raw.isEmpty():
            log.warning("%s %s: no input, table left as it is", broker.display_name, layer)
            continue
        if broker.prepare:
            if prepared is None:
                prepared = broker.prepare(raw, ledger.key, scratch)
                _warn(broker, prepared)
            raw = prepared
        if layer == "snapshot":
            rows = broker.snapshot(raw, ledger.key)
        else:
            target = {"target": ledger.target} if broker.needs_target else {}
            rows = broker.events(raw, ledger.key, **{**target, **events_options})
        sealed = conform(encrypt_columns(rows, money, ledger.key), schema)
        ledger.lake.overwrite(sealed, "normalized", f"{broker.name}_{layer}")
        written.append(layer)
    return written


def _warn(broker: Broker, prepared: object) -> None:
    counts = broker.notes(prepared).first().asDict() if broker.notes else {}
    for name, count in counts.items():
        if count:
            log.warning("%s: %d %s", broker.display_name, count, name.replace("_", " "))


def run_broker(
    ledger: Ledger, name: str, batches: Mapping[str, Iterable[DataFrame]], *, now: datetime | None = None,
    **events_options,
) -> int:
    """Ingest the batches of each layer, transform, validate. No batch at all is a skip (exit code 0)."""
    broker = BROKERS[name]
    current: dict[str, DataFrame] = {}
    ingested = 0
    for layer, frames in batches.items():
        stored = [ingest_raw(ledger, frame, name, broker.uses_current_batch) for frame in frames]
        ingested += len(stored)
        if stored and broker.uses_current_batch:
            current[layer] = union_all(stored, ledger.spark, RAW)
    if not ingested:
        log.info("%s: nothing to ingest, skipped", broker.display_name)
        return 0
    try:
        if broker.event_sources and "events" in current:
            require_sources(current["events"], broker.event_sources)  # a part of the history must not replace it
        transform_broker(ledger, broker, current, **events_options)
    finally:
        ledger.lake.clear_stash()
    return validate(ledger, tables=[f"{name}_snapshot", f"{name}_events"], connectors=[name], now=now)


# ---------------------------------------------------------------- consolidation


def consolidate(ledger: Ledger, now: datetime | None = None) -> None:
    """All brokers' snapshots to ``consolidated_holdings``; raises when there is none."""
    now = now or datetime.now(UTC)
    held = []
    for name, broker in BROKERS.items():
        snapshot = ledger.lake.find("normalized", f"{name}_snapshot")
        if snapshot is None:
            log.info("%s: no snapshot, skipped", broker.display_name)
            continue
        held.append(broker.holdings(decrypt_columns(snapshot, SNAPSHOT_MONEY, ledger.key)))
    merged = None
    for frame in held:
        merged = frame if merged is None else merged.unionByName(frame)
    if merged is None or merged.isEmpty():
        raise NoHoldingsError("no holdings; run the broker transforms first")
    rows = consolidate_holdings(
        merged, ledger.rate_table(), ledger.target, F.lit(now).cast("timestamp")
    )
    sealed = conform(encrypt_columns(rows, HOLDINGS_MONEY, ledger.key), CONSOLIDATED_HOLDINGS)
    ledger.lake.overwrite(sealed, "normalized", "consolidated_holdings")


def consolidate_ledger(ledger: Ledger) -> None:
    """All brokers' events, deduplicated and converted, to ``events`` in one plan and one write."""
    frames = []
    for name, broker in BROKERS.items():
        frame = ledger.lake.find("normalized", f"{name}_events")
        if frame is None:
            log.warning("%s: no events table, skipped", broker.display_name)
        frames.append(frame)
    merged = consolidate_events(ledger.spark, frames, encrypted=True)
    _write_converted(ledger, merged)


def normalize_events(ledger: Ledger) -> None:
    """Convert the stored ``events`` again, in place."""
    _write_converted(ledger, ledger.lake.read("normalized", "events"))


def _write_converted(ledger: Ledger, sealed_events: DataFrame) -> None:
    """Convert and store events; the stored table stays when a currency has no rate.

    Rows without a rate are counted while the new table is written beside the
    old one, so the check costs no pass of its own; they are named only when
    there are any. Only the two columns the conversion needs are opened, the
    amount keeps its token.
    """
    opened, rates = _keep_sealed(sealed_events, ledger.key), ledger.rate_table()
    counted = Observation("conversion") if ledger.lake.swaps else None
    converted = normalize_currency(opened, rates, ledger.target, observation=counted)
    sealed = encrypt_columns(converted, ("target_fx_rate", "target_value"), ledger.key)
    restored = conform(sealed.withColumn("cash_amount", F.col("__sealed_amount")), EVENTS)

    def approve() -> None:
        if counted is not None and observed(counted, "stuck") != 0:
            require_convertible(opened, rates, ledger.target)

    ledger.lake.overwrite(restored, "normalized", "events", approve=approve)


def _keep_sealed(events: DataFrame, key: Key) -> DataFrame:
    """Events with amount and broker rate opened, the amount's token kept aside."""
    copied = events.withColumn("__sealed_amount", F.col("cash_amount"))
    return decrypt_columns(copied, ("cash_amount", "target_fx_rate"), key)


# ---------------------------------------------------------------- analytics


def build_holdings(ledger: Ledger, now: datetime) -> None:
    held = decrypt_columns(ledger.lake.read("normalized", "consolidated_holdings"), HOLDINGS_MONEY, ledger.key)
    rows = encrypt_columns(portfolio_holdings(held), HOLDINGS_MONEY, ledger.key)
    _write_gold(ledger, rows, PORTFOLIO_HOLDINGS, "portfolio_holdings", now)


def income_rollup(ledger: Ledger) -> DataFrame:
    """The aggregate the three income tables follow from, in one pass over the events.

    The same pass counts events without target value or currency, and fails on
    them. Only the two summed columns are decrypted. The (small) result is
    written to the shared folder, so that building three tables reads the events once.
    """
    used = (
        "event_type", "event_datetime", "event_id", "broker", "ticker", "isin", "description",
        "security_ccy", "instrument_ccy", "target_ccy", *INCOME_MONEY,
    )
    events = ledger.lake.read("normalized", "events").select(*used)
    counted = Observation("targets")
    watched = events.observe(counted, F.count_if(lacks_target()).alias("missing"))
    base = ledger.lake.stash(income_base(with_periods(decrypt_columns(watched, INCOME_MONEY, ledger.key))), "income")
    require_target(events, observed(counted, "missing"))
    return base


_INCOME = {
    "dividend_income": DIVIDEND_INCOME,
    "interest_income": INTEREST_INCOME,
    "cash_flow_summary": CASH_FLOW_SUMMARY,
}


def build_income(ledger: Ledger, name: str, now: datetime, rollup: DataFrame | None = None) -> None:
    rows = income_tables(income_rollup(ledger) if rollup is None else rollup)[name]
    _write_gold(ledger, encrypt_columns(rows, INCOME_MONEY, ledger.key), _INCOME[name], name, now)


def _write_gold(ledger: Ledger, rows: DataFrame, schema, name: str, now: datetime) -> None:
    stamp = F.lit(now).cast("timestamp")
    ledger.lake.overwrite(conform(rows, schema, calculated_at=stamp), "analytics", name)


def run_analytics(ledger: Ledger, now: datetime | None = None) -> int:
    """Build every analytics table; each builder runs even if another failed, any failure gives 1."""
    now = now or datetime.now(UTC)
    failed = 0

    def attempt(name: str, build: Callable[[], DataFrame | None]) -> DataFrame | None:
        nonlocal failed
        try:
            return build()
        except Exception as exc:
            log.warning("%s failed: %s", name, exc)
            failed = 1
            return None

    attempt("portfolio_holdings", lambda: build_holdings(ledger, now))
    rollup = attempt("income rollup", lambda: income_rollup(ledger))
    if rollup is not None:
        for name in _INCOME:
            attempt(name, lambda name=name: build_income(ledger, name, now, rollup))
    ledger.lake.clear_stash()
    return failed


# ---------------------------------------------------------------- validation


def validate(
    ledger: Ledger, tables: Iterable[str] | None = None, connectors: Iterable[str] | None = None,
    freshness_days: int = 7, fail_on_warn: bool = False, now: datetime | None = None,
) -> int:
    """Check the tables, append the results to ``data_quality``, return the exit code."""
    now = now or datetime.now(UTC)
    connectors = None if connectors is None else list(connectors)
    lake = ledger.lake
    history = lake.find("analytics", "data_quality")
    before = {}
    if history is not None:
        before = {r.table_name: r.previous for r in previous_counts(history).filter(F.col("table_name").isin(*CHECKED_TABLES)).collect()}
    results: list[tuple[str, Check]] = []
    for name in select_tables(tables, connectors):
        spec = CHECKED_TABLES.get(name)
        if spec is None:
            results.append((name, Check("table_present", WARN, f"unknown table {name}")))
            continue
        table = lake.find(spec.layer, name)
        if table is None:
            results.append((name, Check("table_present", WARN, f"table {name} not found")))
            continue
        checks = table_checks(
            name, table, previous=before.get(name), now=now, freshness_days=freshness_days,
            must_have_rows=connectors is not None and name in {f"{c}_events" for c in connectors},
        )
        if name == "consolidated_holdings":
            checks.append(reconciliation_check(table, lake.find("normalized", "events")))
        results += [(name, c) for c in checks]
    lake.append(results_frame(ledger.spark, results, now).coalesce(1), "analytics", "data_quality")
    for name, check in results:
        log.log(logging.INFO if check.status != FAIL else logging.ERROR, "[%s] %s/%s: %s", check.status, name, check.name, check.details)
    return exit_code((c for _, c in results), fail_on_warn)


def run_consolidation(
    ledger: Ledger, connectors: Iterable[str] = (), now: datetime | None = None
) -> int:
    """Consolidate, convert, validate silver, analyse, validate gold; stops at the first failure."""
    connectors = list(connectors)
    try:
        consolidate(ledger, now)
        consolidate_ledger(ledger)
    except (NoHoldingsError, ConversionError) as exc:
        log.error("consolidation failed: %s", exc)
        return 1
    silver = ["consolidated_holdings", "events", *[f"{c}_events" for c in connectors]]
    return (
        validate(ledger, silver, connectors, now=now)
        or run_analytics(ledger, now)
        or validate(
            ledger, ["portfolio_holdings", "dividend_income", "interest_income", "cash_flow_summary"], connectors, now=now
        )
    )


def quality_history(ledger: Ledger) -> DataFrame:
    return ledger.lake.read_or_empty("analytics", "data_quality", DATA_QUALITY)
