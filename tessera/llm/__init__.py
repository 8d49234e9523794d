"""Operators of a training-data pipeline (ten of them) and their queries.

Nothing else in the library imports this subpackage; it may be removed as a
whole. Every operator takes and returns DataFrames."""
