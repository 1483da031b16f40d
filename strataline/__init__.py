"""Layered (raw, cleaned, reporting) sales analytics as Spark DataFrame jobs."""
