"""Per-broker mappings from raw rows to the snapshot and event schemas."""

from __future__ import annotations

from tally.brokers import ibkr, trading212, xtb
from tally.brokers.base import Broker

BROKERS: dict[str, Broker] = {b.name: b for b in (ibkr.BROKER, trading212.BROKER, xtb.BROKER)}

__all__ = ["BROKERS", "Broker"]
