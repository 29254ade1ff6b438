"""Scans, sinks and the tables that describe them."""
