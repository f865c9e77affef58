"""Retail lakehouse analytics as PySpark DataFrame jobs."""
