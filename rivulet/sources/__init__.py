"""Batch sources: delimited files, text lines, tab lookups, document parsers."""
