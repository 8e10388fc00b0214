"""Readers, writers and the published tables."""
