"""Enrichment of new rows only."""
