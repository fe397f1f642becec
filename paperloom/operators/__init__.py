"""Jobs as functions from DataFrames to DataFrames."""
