"""Sources of the catalog engine."""
