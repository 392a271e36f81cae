"""tally - a PySpark-native ledger for multi-broker investment portfolios."""

from tally.session import build_session, use_utc

__all__ = ["build_session", "use_utc"]
