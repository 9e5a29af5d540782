"""Readers: change streams, dimension snapshots, rule files, state lookups."""
