"""Spatial allocation analytics on Spark DataFrames."""
