"""Spark jobs that turn OpenStreetMap-shaped tables into offline map data."""
