"""Readers, writers and catalogue access."""
