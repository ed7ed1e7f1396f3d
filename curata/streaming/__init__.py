"""Structured Streaming forms of the news and job jobs."""
