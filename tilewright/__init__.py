"""Raster-tile analytics as plain PySpark DataFrame transformations."""
