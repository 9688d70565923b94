"""Registered queries over the test tables."""
