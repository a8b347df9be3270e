"""Readers with explicit schemas, job-shaped fixtures and report sinks."""
