"""Curation of nested, changing documents into clean tables, on Spark DataFrames."""
