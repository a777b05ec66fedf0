"""Keyed lake tables, change capture, event streams and volatility analytics on Spark."""
