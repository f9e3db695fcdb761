"""Scans, catalogs, object stores and sinks."""
