"""Readers for event streams, event files and reference files."""
