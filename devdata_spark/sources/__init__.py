"""Readers of landed publisher files. Fetching them is outside Spark."""
