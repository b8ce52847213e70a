"""DataFrame-level operators: pure functions, table names and I/O stay outside."""
