"""Structured Streaming counterparts of the incremental write modes."""
