"""One ledger of events across brokers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tally.operators.dedup import LEDGER_EVENT_KEY, dedup_newest
from tally.operators.shaping import union_all
from tally.schemas import EVENTS, plain


def consolidate_events(
    spark: SparkSession, frames: Iterable[DataFrame | None], *, tiebreak: Sequence[Column] | None = None,
    encrypted: bool = False,
) -> DataFrame:
    """Union of the brokers' events, newest version per (broker, type, id, account).

    Brokers without a table are None. Works on encrypted rows too, as no key
    column is encrypted.
    """
    merged = union_all(frames, spark, EVENTS if encrypted else plain(EVENTS))
    return dedup_newest(merged, LEDGER_EVENT_KEY, tiebreak=tiebreak)
