"""Structured Streaming drivers for the warehouse jobs."""
