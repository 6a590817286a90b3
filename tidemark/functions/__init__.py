"""Column builders: hashes, computed and default columns, null ordering, JSON access."""
