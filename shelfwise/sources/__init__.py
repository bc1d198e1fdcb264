"""Scans, sinks, export encoding and record extraction from stored pages."""
