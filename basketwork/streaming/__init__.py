"""Structured Streaming form of the transaction feed."""
