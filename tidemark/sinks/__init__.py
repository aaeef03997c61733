"""Sinks: tables written for training, search, evaluation and replay, and read back."""
