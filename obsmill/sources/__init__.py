"""Readers for plans, identifiers, landed frames and responses, plus user adapters."""
