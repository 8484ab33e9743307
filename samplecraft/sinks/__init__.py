"""Sinks: shaping and writing samples."""
