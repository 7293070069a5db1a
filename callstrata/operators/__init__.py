"""Transformations between the tables of the archive."""
