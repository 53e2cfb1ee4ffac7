"""Inputs: streams and batches of messages, Parquet and CSV files."""
