"""Spark-first engine for building land parcels from points and polygons."""

__version__ = "0.1.0"
