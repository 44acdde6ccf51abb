"""Whole jobs: the star build and the reports on it."""
