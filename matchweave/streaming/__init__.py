"""Structured Streaming jobs: file ingest and running history compaction."""
