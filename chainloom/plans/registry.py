"""Names of all ledger queries with their DataFrame builders and SQL."""

from __future__ import annotations

from chainloom.plans import chain, files, measures, messages, monitoring, parameters, staking, stored, streams, tables, wallets
from chainloom.plans.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "chain", "files", "measures", "messages", "monitoring", "parameters", "staking", "stored", "streams", "tables", "wallets"]
