"""Tidegauge: operations analytics on PySpark DataFrames."""
