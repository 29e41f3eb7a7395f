"""File ingest and the adapters that shape the lake tables into case tables."""
