"""Listing analytics on Spark: parsing, registry upserts, curation, publication."""
