"""Structured Streaming form of the daily job."""
