"""Supervised-classification analytics on Spark DataFrames."""
