"""Readers, writers and raw-payload flattening."""
