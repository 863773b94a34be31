"""Landed responses -> typed rows, and rows -> files."""
