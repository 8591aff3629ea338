"""Structured Streaming versions of the landing -> minute -> hour jobs."""
