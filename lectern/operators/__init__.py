"""Operators: functions from DataFrames to DataFrames, without a session of their own and without collecting rows."""
