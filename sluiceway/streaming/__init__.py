"""Streaming use of the batch operators: pickup of files, gates per micro-batch, unique keys."""
