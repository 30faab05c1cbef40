"""Operators that a training-data pipeline needs, one module each.

Nothing else in the library imports this package; ``llm.queries`` registers
the operators' queries and their SQL.
"""
