"""Feeds, mappings and slowly changing dimensions on Spark DataFrames."""
