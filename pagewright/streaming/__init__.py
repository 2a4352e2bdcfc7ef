"""Structured Streaming over files of blocks."""
