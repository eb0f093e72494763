"""Catalogue analytics on Spark: ingest, clean, check and score games and their user tags."""

from tagshelf.tables import Tables

__all__ = ["Tables"]
