"""Plans of the catalog engine."""
