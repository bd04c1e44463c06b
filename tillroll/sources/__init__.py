"""Readers and writers: CSV exports, the star-schema stand-in, catalog tables."""
