"""Readers, writers and raw-shaped views."""
