"""Readers for text, tables and streams."""
