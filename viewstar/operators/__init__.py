"""Operators over DataFrames: numbering, members, lookups, dimensions, fact, checks."""
