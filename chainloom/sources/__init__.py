"""Sources: driver tables as ledger-shaped views, nested block files, reference dimensions."""
