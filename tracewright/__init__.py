"""Spark operators for building and checking tool-call datasets over map scenarios."""
