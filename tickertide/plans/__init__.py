"""Whole runs: state, stages and reports."""
