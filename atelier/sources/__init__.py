"""Readers with stated schemas, and sinks."""
