"""Spark jobs for document evidence work."""
