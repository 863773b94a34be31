"""Column -> Column building blocks; everything here is a native Spark expression."""
