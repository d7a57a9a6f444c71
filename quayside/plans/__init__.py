"""Registered batch queries (one per inventory item) and their SQL oracles."""
