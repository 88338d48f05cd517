"""Queries over the test tables, each with its check in SQL."""
