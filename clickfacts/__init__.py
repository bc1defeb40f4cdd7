"""Clickstream facts on Spark: validation, cleaning, daily facts and reports as DataFrame jobs."""
