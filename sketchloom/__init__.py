"""Set-similarity search and sketches on Spark DataFrames."""
