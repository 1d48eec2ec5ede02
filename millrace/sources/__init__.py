"""Readers, writers and connector options."""
