"""Structured Streaming forms of the tick and indicator operators."""
