"""Change-stream processing and analytics expressed with PySpark DataFrames."""
