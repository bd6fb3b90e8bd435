"""Structured Streaming jobs: scoring payload streams (T1) and monitoring rates."""
