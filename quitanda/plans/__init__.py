"""Whole jobs: the batch run, the warehouse load and the reports."""
