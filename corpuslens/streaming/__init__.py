"""Structured Streaming forms of loading and threading."""
