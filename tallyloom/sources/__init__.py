"""Readers: tables, wide-column cells, logs, places and files."""
