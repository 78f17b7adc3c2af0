"""Hybrid star-rating prediction as Spark jobs."""
