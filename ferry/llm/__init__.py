"""Operators of a training-data pipeline. Each module holds one operator; `queries` registers them on the given tables."""
