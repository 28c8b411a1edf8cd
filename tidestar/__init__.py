"""Change-data to star-schema operators on PySpark DataFrames and Structured Streaming."""
