"""Retail-banking analytics on Spark DataFrames."""
