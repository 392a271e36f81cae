"""Latest-version selection and replay removal.

``row_number() = 1`` is planned with a partial group limit before the shuffle:
every map task keeps one row per key, so a key that holds a large part of all
rows (replayed copies) reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.operators.shaping import keys_of, match_keys

RAW_KEY = ("broker", "source", "payload_hash")
IBKR_EVENT_KEY = ("event_id",)
TRADING212_EVENT_KEY = ("event_type", "event_id")
XTB_EVENT_KEY = ("event_type", "event_id", "account_id")
LEDGER_EVENT_KEY = ("broker", "event_type", "event_id", "account_id")


def row_mark(df: DataFrame) -> Column:
    """A hash of the row, the tiebreak between rows of equal age."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys form a key of their own."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank")
    )


def dedup_newest(
    df: DataFrame,
    keys: Sequence[str],
    *,
    newest: str = "fetched_at",
    tiebreak: Sequence[Column] | None = None,
    sort_after: Sequence[str] | None = None,
) -> DataFrame:
    """Newest version of every key. ``sort_after`` orders the output, for display only."""
    order = [F.col(newest).desc_nulls_last(), *(tiebreak or [row_mark(df)])]
    out = keep_first(df, keys, order)
    return out.orderBy(*sort_after) if sort_after else out


def duplicates_removed(before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows :func:`dedup_newest` takes away: one row, ``rows``, ``kept``, ``removed``."""
    per_key = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
    )


def latest_per_source(df: DataFrame, key: str = "source", newest: str = "fetched_at") -> DataFrame:
    """All rows of the latest fetch of every source.

    The maxima are a map-side aggregate over two pruned columns and join back to
    the rows, so a source that holds most rows is never gathered in one task:
    adaptive execution broadcasts the maxima when they turn out small and splits
    a source's rows when they don't.
    """
    latest = df.groupBy(F.col(key).alias("__key")).agg(F.max(newest).alias("__newest"))
    on = df[key].eqNullSafe(latest["__key"]) & (df[newest] == latest["__newest"])
    return df.join(latest, on, "left_semi")


def drop_known(incoming: DataFrame, existing: DataFrame, keys: Sequence[str] = RAW_KEY) -> DataFrame:
    """Incoming rows whose key is not in ``existing`` (null equals null).

    Only the key columns of the existing table are read. Its copies are folded
    map-side before the shuffle; copies inside the incoming batch all stay, and
    a hot key among them is split by the adaptive skew join.
    """
    return incoming.join(keys_of(existing, keys), match_keys(incoming, keys), "left_anti")


# Where a stored row lies; together they name one row.
ADDRESS = ("__file", "__row")


def addressed(table: DataFrame) -> DataFrame:
    """A table read from files, with every row's file and number in it."""
    return table.select("*", F.col("_metadata.file_path").alias(ADDRESS[0]), F.col("_metadata.row_index").alias(ADDRESS[1]))


def winners(df: DataFrame, keys: Sequence[str], address: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """The address of each key's newest row; null keys are a key of their own.

    One aggregate over narrow columns, which every map task folds before the shuffle. Equally old rows (undated ones
    come last) are told apart by ``tiebreak``, then by address, the smallest first.
    """
    age = F.coalesce(-F.unix_micros(F.col("fetched_at").cast("timestamp")), F.lit((1 << 63) - 1)).alias("__age")
    first = df.groupBy(*keys).agg(F.min(F.struct(age, *tiebreak, *address)).alias("__won"))
    return first.select(*[F.col(f"__won.{a}").alias(a) for a in address])


def merge_newest(
    df: DataFrame, tiebreak: Sequence[Column] | Sequence[str] | None = None, address: Sequence[str] | None = None
) -> DataFrame:
    """Raw rows of several tables merged: newest per content key, with its ``source_file``.

    With the columns of an ``address`` (see :func:`addressed`) the winners are found among keys and times alone, and
    their rows, payloads included, are fetched by a semi-join that hashes the addresses: a payload is neither sorted nor
    does it pass through a window. ``tiebreak`` then names columns, by which the smallest of equally old rows wins. Rows
    without an address are ranked whole.
    """
    if address is None:
        return dedup_newest(df, RAW_KEY, tiebreak=tiebreak)
    won = winners(df, RAW_KEY, address, tiebreak or ())
    return df.join(won.hint("shuffle_hash"), list(address), "left_semi").drop(*address)


def orphans(destination: DataFrame, merged: DataFrame, keys: Sequence[str] = RAW_KEY) -> DataFrame:
    """Destination keys that no merged row has."""
    held = destination.select(*keys).distinct()
    return held.join(keys_of(merged, keys), match_keys(held, keys), "left_anti")
