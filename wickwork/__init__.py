"""Wickwork: OHLCV market analytics as Spark DataFrame jobs."""
