"""Spark-first analytics for document evidence: operators are functions from DataFrames to DataFrames."""
