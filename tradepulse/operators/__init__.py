"""Batch DataFrame operators; the streaming job calls the same functions."""
