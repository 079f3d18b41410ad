"""Transaction-structuring analytics on Spark DataFrames."""
