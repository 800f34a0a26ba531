"""Schemas, fixture views, landed-file reads and versioned publishing."""
