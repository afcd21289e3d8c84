"""Spark analytics marts: staging, marts, quality checks and event ingestion as DataFrame functions."""
