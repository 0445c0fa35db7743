"""Column-level building blocks: header names, dates, numbers, text."""
