"""Row-wise operators on Structured Streaming DataFrames."""
