"""Incremental loading. It is batch and key-based: each run works on what storage has and the tables lack."""
