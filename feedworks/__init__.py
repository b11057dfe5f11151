"""Landing semi-structured feeds as tables with Spark DataFrames."""
