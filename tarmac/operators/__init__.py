"""Operators: functions from DataFrames to a DataFrame, from which the reports are put together."""
