"""Scans, sinks and the test catalogs derived from the supplied tables."""
