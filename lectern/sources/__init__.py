"""Readers, format rules and sinks."""
