"""Readers, writers, session settings and the append-only run tables."""
