"""Counts that grow with a run."""
