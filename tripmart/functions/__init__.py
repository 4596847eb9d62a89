"""Building blocks for columns and whole frames."""
