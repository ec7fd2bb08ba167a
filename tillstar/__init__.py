"""Retail data quality and star-schema building on Spark DataFrames."""
