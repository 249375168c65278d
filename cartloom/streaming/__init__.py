"""Incremental ingestion of landed search responses (Structured Streaming)."""
