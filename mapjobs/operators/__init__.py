"""Jobs: DataFrames in, DataFrame out."""
