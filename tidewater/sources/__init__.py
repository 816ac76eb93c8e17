"""Readers, catalogue views and writers."""
