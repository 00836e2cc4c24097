"""Spark jobs for greenhouse-gas disclosure data."""
