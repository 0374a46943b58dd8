"""Structured Streaming: incremental ingestion of the landing folder."""
