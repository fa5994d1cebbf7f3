"""Trend analytics over a message stream and a news table, on Spark DataFrames."""
