"""Relational operators over the weekly tables."""
