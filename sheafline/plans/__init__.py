"""Mapping plans that turn records and graphs into research objects."""
