"""Readers, writers and saved states."""
