"""Structured Streaming ingest of landed exports."""
