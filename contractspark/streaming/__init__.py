"""Streaming: a contract applied to a stream."""
