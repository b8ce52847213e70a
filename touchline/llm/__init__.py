"""Operators for preparing training text; see queries.py for the registered queries."""
