"""Readers, writers and the shared work folder."""
