"""Readers and writers for landed tables, delimited files and snapshots."""
