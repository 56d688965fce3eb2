"""Catalog consolidation, title matching and page attributes on Spark DataFrames."""
