"""Housing-market analytics on Spark DataFrames."""
