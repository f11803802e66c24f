"""Change-data-capture lakehouse analytics as Spark DataFrames."""
