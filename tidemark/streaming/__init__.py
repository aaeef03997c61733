"""Streams of change capture."""
