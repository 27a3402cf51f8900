"""Sources: the contract as a read schema and load projection (L1-L3), contract files as tables (L4)."""
