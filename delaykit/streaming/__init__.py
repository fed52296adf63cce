"""Structured Streaming jobs: incremental ingest of landed files (T1) and
continuous scoring of prediction requests (T2)."""
