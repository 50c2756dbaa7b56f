"""Relational building blocks; every one takes column names as arguments."""
