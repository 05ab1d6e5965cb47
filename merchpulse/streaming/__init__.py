"""Structured Streaming: on-request ("online") scoring of merchants."""
