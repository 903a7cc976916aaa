"""Region-partitioned bank analytics on Spark DataFrames."""
