"""Structured Streaming: windows, running counts, sliced generation, checks on each batch."""
