"""Continuous ingest."""
