"""Readers of object tables, files and the stand-ins over the test tables."""
