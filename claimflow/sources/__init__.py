"""Readers, writers and the layer catalogue."""
