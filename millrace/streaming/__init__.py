"""Structured Streaming jobs: summaries, running state, an online model."""
