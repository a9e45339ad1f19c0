"""Warehouse operators for Spark: plain functions over DataFrames."""

__version__ = "0.1.0"
