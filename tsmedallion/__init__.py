"""Medallion analytics for numeric time series, built on PySpark DataFrames."""
