"""Capture and table connectors."""
