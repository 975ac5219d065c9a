"""Relational operators composed of DataFrame operations."""
