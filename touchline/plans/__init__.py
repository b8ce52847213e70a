"""Composite plans: silver transforms, gold marts, quality suites, lookups."""
