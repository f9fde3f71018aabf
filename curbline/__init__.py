"""Curbline: monthly trip-record analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; nothing runs until an
action asks for it, except where a docstring says otherwise.
"""
