"""Structured Streaming twins of the slotted operators."""
