"""Catalogue building, enrichment and ranked search as plain Spark DataFrame operations."""
