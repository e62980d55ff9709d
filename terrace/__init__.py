"""Layered-warehouse, data-quality and sensor-series toolkit on PySpark."""
