"""Incremental runs on micro-batches."""
