"""Warehouse steps as DataFrame -> DataFrame functions (batch and stream)."""
