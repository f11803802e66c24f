"""Change-data, as-of, quality, table and monitoring operators on DataFrames."""
