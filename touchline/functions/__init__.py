"""Column-level building blocks (Column in, Column out; no I/O, no actions)."""
