"""Readers for tiles, catalogs and job orders."""
