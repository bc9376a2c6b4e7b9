"""Land-change analytics on Spark DataFrames."""
