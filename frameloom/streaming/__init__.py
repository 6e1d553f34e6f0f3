"""Structured Streaming forms of the ingest. An extension: nothing in the batch pipeline needs them."""
