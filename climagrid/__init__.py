"""Batch climate analytics over daily observations by place, on Spark DataFrames."""
