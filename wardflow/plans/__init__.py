"""Whole jobs: operators joined with their reads and writes."""
