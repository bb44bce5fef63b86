"""Incremental processing of newly landed raw payloads (Structured Streaming)."""
