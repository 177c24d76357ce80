"""Structured Streaming versions of the counting, feature and scoring jobs."""
