"""Queries over the test tables, each next to the SQL that must give the same rows."""
