"""Structured Streaming entry points (scoring of incoming requests)."""
