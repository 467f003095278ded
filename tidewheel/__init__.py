"""Station-based trip analytics on Spark DataFrames."""
