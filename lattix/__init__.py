"""Property graphs and corpus preparation on Spark DataFrames."""
