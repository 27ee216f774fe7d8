"""Tolerant scans. Content problems become issue rows, never exceptions."""
