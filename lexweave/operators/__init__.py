"""Operators of the library."""
