"""Retail stream and batch analytics as DataFrame -> DataFrame functions on Spark SQL and Structured Streaming."""
