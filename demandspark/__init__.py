"""Sales-forecast operators on Spark DataFrames."""
