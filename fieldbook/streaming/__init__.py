"""Structured Streaming ingestion of landed form exports."""
