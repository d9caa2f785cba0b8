"""Readers of message streams and of result tables."""
