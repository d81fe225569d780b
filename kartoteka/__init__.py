"""Kartoteka: catalog analytics as Spark DataFrame jobs."""
