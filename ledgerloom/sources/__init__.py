"""Scans: files, latest runs, landing folders, databases."""
