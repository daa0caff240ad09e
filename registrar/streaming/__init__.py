"""Structured Streaming forms of the two derived-state rules."""
