"""Readers that turn landed JSON and HTML into typed rows."""
