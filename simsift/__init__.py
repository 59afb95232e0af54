"""Exact fingerprint-similarity search and corpus jobs on Spark DataFrames."""
