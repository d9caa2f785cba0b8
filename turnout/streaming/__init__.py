"""Sinks for micro-batches and the streaming queries that feed them."""
