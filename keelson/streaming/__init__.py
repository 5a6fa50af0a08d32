"""Structured Streaming: a commit-log watcher that runs a job per batch of new commits."""
