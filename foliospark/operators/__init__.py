"""Operators of foliospark: functions from DataFrames to DataFrames."""
