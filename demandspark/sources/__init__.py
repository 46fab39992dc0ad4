"""Scans, sinks and the mapping of source tables onto sales lines."""
