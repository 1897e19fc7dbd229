"""Readers, writers and the schemas of the source tables."""
