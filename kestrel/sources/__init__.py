"""Readers: supplied tables, text and side files, multi-file formats."""
