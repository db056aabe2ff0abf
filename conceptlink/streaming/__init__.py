"""Jobs over streaming DataFrames."""
