"""Incremental form of the periodic report."""
