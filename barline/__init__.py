"""Daily price-series analytics on Spark DataFrames."""
