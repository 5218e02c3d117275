"""Structured Streaming intake and upsert."""
