"""Structured Streaming jobs made of the batch operators."""
