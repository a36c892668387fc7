"""Whole jobs: single-file, combined and collect-then-analyse."""
