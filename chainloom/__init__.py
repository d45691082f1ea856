"""Ledger analytics on Spark: declarative DataFrame operators over block, transaction and stake tables."""
