"""Training-data operators on Spark DataFrames.

Each module holds one operator; nothing outside this package imports it.
"""
