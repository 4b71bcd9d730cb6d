"""Scans: one function per file format, each with typed columns and the order of the lines."""
