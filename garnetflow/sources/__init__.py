"""Scans of landed files and of artifacts, and what writes them."""
