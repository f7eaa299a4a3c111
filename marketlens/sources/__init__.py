"""Schemas, readers and the test-data adapter."""
