"""Readers, writers and fingerprints."""
