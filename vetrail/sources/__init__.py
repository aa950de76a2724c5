"""Readers with declared schemas, and sinks."""
