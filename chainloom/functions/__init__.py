"""Column -> Column scalar functions of the ledger domain."""
