"""Relational operators over the ratings / movies tables."""
