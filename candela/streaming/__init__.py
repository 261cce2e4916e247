"""Structured Streaming runners over the batch operators."""
