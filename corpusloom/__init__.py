"""Corpus curation operators for Spark."""
