"""Operators of a training-data pipeline: one module per operator, queries and DuckDB SQL in ``queries``."""
