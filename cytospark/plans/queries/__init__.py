"""Registered queries by topic."""
