"""Spark jobs that turn nested game documents into tidy per-game, per-team and per-player tables."""
