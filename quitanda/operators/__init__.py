"""Cleaning, key lookup, dimension and fact operators, and quality reports."""
