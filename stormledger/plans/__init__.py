"""Ordered runs of the analysis steps."""
