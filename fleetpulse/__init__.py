"""Reliability analytics for fleets of devices, on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame; see README.md for the map.
"""
