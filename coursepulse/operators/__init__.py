"""Operators over the course, lecture and snapshot tables."""
