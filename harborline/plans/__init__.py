"""Analytical plans over the operational tables."""
