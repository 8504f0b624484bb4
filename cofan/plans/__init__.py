"""Registered queries (driver contract), their SQL oracles, and batch runs."""
