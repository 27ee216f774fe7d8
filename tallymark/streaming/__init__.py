"""Incremental revalidation."""
