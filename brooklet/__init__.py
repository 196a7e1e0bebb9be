"""Message logs and files into clean, queryable keyed tables, on Spark's own DataFrames and streams."""
