"""Readers, writers, dimensions and the readings derived from the given tables."""
