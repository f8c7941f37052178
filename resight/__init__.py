"""Resight: sighting-catalogue analytics as Spark DataFrame jobs."""
