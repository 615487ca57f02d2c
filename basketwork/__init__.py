"""Retail ELT, quality, lineage and analytics as Spark DataFrame jobs."""
