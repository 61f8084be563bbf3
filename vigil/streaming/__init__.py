"""Incremental (monthly) processing with Structured Streaming."""
