"""Structured Streaming jobs: batch-equivalent scoring and windowed error monitoring."""
