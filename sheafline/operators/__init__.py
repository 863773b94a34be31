"""Relational operators: DataFrame -> DataFrame."""
