"""Relational operators: functions from DataFrames to DataFrames.

The same functions serve batch tables and streams; none of them runs an action.
"""
