"""Wiki-dump analytics on Spark: sources, transforms, checks and queries."""
