"""Record-level and table-level operators: DataFrames in, DataFrames out."""
