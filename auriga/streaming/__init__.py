"""Structured Streaming jobs: incremental ingest, silver appends, daily telemetry."""
