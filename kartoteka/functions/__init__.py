"""Functions of the catalog engine."""
