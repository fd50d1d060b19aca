"""Retail star-schema analytics on Spark: cleaning, dimensions, enrichment, OLAP."""
