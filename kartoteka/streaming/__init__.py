"""Streaming of the catalog engine."""
