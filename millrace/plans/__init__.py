"""Analytical reports over the stored tables."""
