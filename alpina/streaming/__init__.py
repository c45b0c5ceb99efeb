"""Streaming use of the row-local operators."""
