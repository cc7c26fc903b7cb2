"""Operators: functions from DataFrames to DataFrames, without files and without actions unless their docstring says so."""
