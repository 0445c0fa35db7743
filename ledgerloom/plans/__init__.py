"""Composed jobs: what a user calls."""
