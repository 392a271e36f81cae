"""Compositions: ingestion, per-broker runs, consolidation, report, registered queries."""
