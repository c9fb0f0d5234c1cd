"""Reusable DataFrame operators that stay distributed under skew."""
