"""Writes: replace, append, partition overwrite, export."""
