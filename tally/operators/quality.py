"""Data-quality checks: one narrow aggregate per table, results as rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.schemas import CHECKED_TABLES, DATA_QUALITY, FAIL, PASS, WARN

DROP_LIMIT = 0.5


@dataclass(frozen=True)
class Check:
    name: str
    status: str
    details: str
    threshold: str | None = None
    actual: str | None = None


# ---------------------------------------------------------------- single checks


def schema_check(actual: T.StructType, expected: T.StructType) -> Check:
    """Same columns, order and types; nullability is not compared."""
    have = [(f.name, f.dataType) for f in actual.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if have == want:
        return Check("schema", PASS, "schema as declared")
    got, issues = dict(have), []
    for name, kind in want:
        if name not in got:
            issues.append(f"missing field: {name}")
        elif got[name] != kind:
            issues.append(f"type mismatch for {name}: expected {kind.simpleString()}, got {got[name].simpleString()}")
    declared = dict(want)
    issues += [f"extra field: {name}" for name, _ in have if name not in declared]
    return Check("schema", FAIL, "; ".join(issues) or "columns out of order")


def null_counts(df: DataFrame, fields: Iterable[str]) -> list[Column]:
    return [F.count_if(F.col(f).isNull()).alias(f) for f in fields if f in df.columns]


def null_report(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """``(field, nulls)`` for every required field, from one aggregate."""
    present = [f for f in fields if f in df.columns]
    counted = df.agg(*null_counts(df, present))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("nulls")) for f in present])
    return counted.select(F.inline(pairs))


def null_check(counts: dict[str, int], required: Iterable[str]) -> Check:
    required = list(required)
    if not required:
        return Check("required_nulls", PASS, "no required fields registered")
    found = [f"{f}: {counts[f]} nulls" for f in required if counts.get(f)]
    if found:
        return Check("required_nulls", FAIL, "nulls in required fields: " + "; ".join(found))
    return Check("required_nulls", PASS, "no nulls in required fields")


def non_empty_check(table: str, rows: int) -> Check:
    if rows:
        return Check("non_empty", PASS, f"{table}: {rows} rows", actual=str(rows))
    return Check("non_empty", WARN, f"{table}: enabled event table has no rows", actual="0")


def row_count_check(rows: int, previous: int | None) -> Check:
    """Warn when more than half of the rows are gone since the previous run."""
    name, actual = "row_count_stability", str(rows)
    if previous is None:
        return Check(name, PASS, "first run, nothing to compare with", actual=actual)
    if rows < previous * DROP_LIMIT:
        return Check(name, WARN, f"row count fell from {previous} to {rows}", ">50% drop", actual)
    return Check(name, PASS, f"row count {rows} (previous {previous})", actual=actual)


def freshness_check(
    table: str, column: str, rows: int, newest: datetime | None, days: int, now: datetime, present: bool = True
) -> Check:
    """Warn when the newest timestamp is older than ``days``."""
    name = "freshness"
    if not present:
        return Check(name, WARN, f"no freshness column {column}")
    if rows == 0:
        return Check(name, PASS, f"{table} is empty, freshness does not apply")
    if newest is None:
        return Check(name, WARN, f"freshness column {column} is null in every row")
    newest = newest if newest.tzinfo else newest.replace(tzinfo=UTC)
    age = (now - newest).days
    if newest < now - timedelta(days=days):
        return Check(name, WARN, f"data is {age} days old (limit {days})", f"<{days} days old", f"{age} days old")
    return Check(name, PASS, f"data is {age} days old (limit {days})")


def uncovered(holdings: DataFrame, events: DataFrame, held: str, seen: str) -> DataFrame:
    """Distinct values of ``held`` among the holdings that no event has under ``seen``."""
    have = holdings.select(F.col(held).alias("value")).distinct()
    known = events.select(F.col(seen).alias("__known")).distinct()
    return have.join(known, F.col("value").eqNullSafe(F.col("__known")), "left_anti")


def _listing(values: DataFrame) -> list[str]:
    """All of them: the stored result names everything that is missing."""
    return [str(r[0]) for r in values.orderBy("value").collect()]


def reconciliation_check(holdings: DataFrame, events: DataFrame | None) -> Check:
    """Brokers and target currencies of the holdings must appear among the events.

    Missing brokers are reported first and alone.
    """
    name = "reconciliation"
    if events is None or events.isEmpty():
        return Check(name, WARN, "no events to reconcile with")
    brokers = _listing(uncovered(holdings, events, "broker", "broker"))
    if brokers:
        return Check(
            name, WARN, f"brokers in holdings but not in events: {brokers}",
            "every holdings broker has events", f"missing: {brokers}",
        )
    codes = _listing(uncovered(holdings, events, "target_ccy", "security_ccy"))
    if codes:
        return Check(
            name, WARN, f"currencies in holdings but not in events: {codes}",
            "every holdings currency has events", f"uncovered: {codes}",
        )
    return Check(name, PASS, "all holdings brokers and currencies have events")


# ---------------------------------------------------------------- history


def previous_counts(history: DataFrame) -> DataFrame:
    """Latest row count per table that did not fail: ``(table_name, previous)``; null when not a whole number."""
    counted = history.filter((F.col("check_name") == "row_count_stability") & (F.col("status") != FAIL))
    latest = counted.groupBy("table_name").agg(F.max_by("actual", F.struct("checked_at", "actual")).alias("actual"))
    return latest.select("table_name", F.col("actual").try_cast("bigint").alias("previous"))


def latest_run(history: DataFrame) -> DataFrame:
    """The results of the most recent run only."""
    return history.filter(F.col("checked_at") == history.agg(F.max("checked_at")).scalar())


# ---------------------------------------------------------------- one table, all checks


def table_checks(
    table: str, df: DataFrame, *, previous: int | None, now: datetime, freshness_days: int = 7,
    must_have_rows: bool = False,
) -> list[Check]:
    """Schema, nulls, row count, freshness and presence of rows, from a single scan."""
    spec = CHECKED_TABLES[table]
    present = spec.freshness in df.columns
    measures = [F.count(F.lit(1)).alias("__rows"), *null_counts(df, spec.required)]
    if present:
        measures.append(F.max(spec.freshness).cast("timestamp").alias("__newest"))
    facts = df.agg(*measures).first().asDict()
    rows = facts["__rows"]
    checks = [
        schema_check(df.schema, spec.schema),
        null_check(facts, spec.required),
        row_count_check(rows, previous),
        freshness_check(table, spec.freshness, rows, facts.get("__newest"), freshness_days, now, present),
    ]
    if must_have_rows:
        checks.append(non_empty_check(table, rows))
    return checks


def select_tables(tables: Iterable[str] | None, connectors: Iterable[str] | None) -> list[str]:
    """The tables of a run; with ``connectors``, other brokers' event tables are left out."""
    names = list(CHECKED_TABLES) if tables is None else list(dict.fromkeys(tables))
    if connectors is None:
        return names
    enabled = {f"{c}_events" for c in connectors}
    return [n for n in names if not n.endswith("_events") or n in enabled]


def results_frame(spark, results: list[tuple[str, Check]], now: datetime) -> DataFrame:
    rows = [(now, table, c.name, c.status, c.details, c.threshold, c.actual) for table, c in results]
    return spark.createDataFrame(rows, DATA_QUALITY)


def exit_code(results: Iterable[Check], fail_on_warn: bool = False) -> int:
    statuses = {c.status for c in results}
    return int(FAIL in statuses or (fail_on_warn and WARN in statuses))
