"""Brightwater: a market-data analytics engine written as Spark jobs."""
