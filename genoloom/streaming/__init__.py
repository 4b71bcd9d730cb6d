"""Streaming forms of associative operators; an addition, nothing in the batch engine depends on it."""
