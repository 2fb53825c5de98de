"""Station-inventory analytics on Spark DataFrames."""
