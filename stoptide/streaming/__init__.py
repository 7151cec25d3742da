"""Structured Streaming jobs. Each drains what is there and stops; the checkpoint resumes."""
