"""Scans, sinks and the leads feature view."""
