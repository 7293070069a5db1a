"""Finished reports: panels, their levels, filter values and alerts."""
