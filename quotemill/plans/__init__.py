"""Registered queries, their check SQL and the data jobs they read."""
