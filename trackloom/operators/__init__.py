"""Track and interval operators as functions from DataFrames to DataFrames."""
