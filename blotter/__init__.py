"""Incident analytics on Spark DataFrames: sources, column functions, operators, reports."""
