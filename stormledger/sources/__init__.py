"""Readers and writers of the input tables."""
