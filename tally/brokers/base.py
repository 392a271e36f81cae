"""What the jobs need from a broker: two transforms over raw rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from tally.operators.holdings import extract_holdings
from tally.schemas import BROKER_NAMES


@dataclass(frozen=True)
class Broker:
    """``snapshot`` and ``events`` take raw rows and a key, and give plain columns.

    ``uses_current_batch`` brokers return their whole history with every fetch,
    so their transforms read the fresh batch instead of the accumulated table.
    ``needs_target`` brokers state rates to their base currency, which count
    only when that is the ledger's target. ``event_sources`` must all be in a batch
    of events that replaces the stored history. ``prepare`` takes raw rows, a key
    and a scratch and does once what both transforms need; they get its result
    for raw rows, and ``notes`` makes one row of counts of it that a run warns of.
    """

    name: str
    snapshot: Callable[..., DataFrame]
    events: Callable[..., DataFrame]
    uses_current_batch: bool = False
    needs_target: bool = False
    event_sources: tuple[str, ...] = ()
    prepare: Callable[..., object] | None = None
    notes: Callable[..., DataFrame] | None = None

    @property
    def display_name(self) -> str:
        return BROKER_NAMES[self.name]

    @property
    def holdings(self) -> Callable[[DataFrame], DataFrame]:
        return partial(extract_holdings, broker=self.name)
