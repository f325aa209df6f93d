"""Marketplace finance and inventory engine on Spark DataFrames."""
