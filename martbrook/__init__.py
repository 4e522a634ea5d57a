"""Retail analytics on Spark: change routing, visitor metrics, wide orders, dashboards."""
