"""Whole runs: the warehouse refresh, and the queries of the driver contract."""
