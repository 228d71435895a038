"""Spatial annotation analytics as Spark plans."""
