"""Structured Streaming jobs. Progress and state live in each query's checkpoint."""
