"""Tamis: corpus preparation and analytics as Spark DataFrame jobs."""
