"""Trip analytics on Spark: landing files, trusted tables, marts and profiles."""
