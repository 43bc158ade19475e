"""Operators: functions from DataFrame to DataFrame with explicit column arguments."""
