"""Retail sales analytics expressed as Spark DataFrame jobs."""
