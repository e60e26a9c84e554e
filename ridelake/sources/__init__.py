"""Readers and file-system helpers."""
