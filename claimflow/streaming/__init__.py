"""Arriving claims and feedback."""
