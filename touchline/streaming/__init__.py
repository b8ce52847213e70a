"""Scheduled loads that pick up only new payload files."""
