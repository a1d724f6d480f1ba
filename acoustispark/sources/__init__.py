"""Scans, derived fixtures, catalogues, message parsing and sinks."""
