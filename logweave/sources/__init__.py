"""Scans, sinks and generators."""
