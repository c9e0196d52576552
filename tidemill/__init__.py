"""Tidemill: layered warehouse operators and jobs on Spark DataFrames and Structured Streaming."""
