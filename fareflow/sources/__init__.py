"""Readers, the reference lists, table writing and period loads."""
