"""Structured Streaming forms of the record and case steps."""
