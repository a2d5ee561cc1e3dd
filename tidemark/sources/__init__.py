"""Scans of landed files and tables, and the sinks of the raw layer."""
