"""Profiling, splitting, regression and model comparison on Spark DataFrames.

Every operator takes and returns DataFrames. No operator creates a session,
uses a Python UDF or moves row-level data through the driver.
"""
