"""Structured Streaming path: topic -> contract split -> silver + dead letters."""
