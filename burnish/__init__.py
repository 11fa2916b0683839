"""Data preparation and data quality on Spark DataFrames."""
