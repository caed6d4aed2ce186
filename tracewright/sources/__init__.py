"""Readers, writers, table schemas and synthetic scenario tables."""
