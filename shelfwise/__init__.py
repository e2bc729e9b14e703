"""Catalog, page and event analytics written as Spark DataFrame jobs."""
