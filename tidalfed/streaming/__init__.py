"""Structured Streaming jobs: windows, rounds, training and keyed state."""
