"""Topics, round logs and the views over the given tables."""
