"""Restartable micro-batch pipelines."""
