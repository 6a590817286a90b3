"""The operators bound to the supplied tables: scenario, query catalogue and SQL checks."""
