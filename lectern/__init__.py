"""Batch analytics over a verse-addressed text corpus, on Spark DataFrames."""
