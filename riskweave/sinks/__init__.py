"""Outputs: stores of scored transactions, refreshed tables, metrics."""
