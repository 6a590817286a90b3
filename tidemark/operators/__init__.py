"""Operators over DataFrames: they take and return DataFrames and never read the clock."""
