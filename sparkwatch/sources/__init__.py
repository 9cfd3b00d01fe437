"""Readers for files and tables, batch and streaming."""
