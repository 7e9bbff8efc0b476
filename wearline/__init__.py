"""Telemetry analytics and model lifecycle on Spark DataFrames."""
