"""Queries over the shared test tables; importing the package registers all of them."""

from gamegrain.catalog import columns, flows, landing, relational, scans, storage, tables  # noqa: F401
from gamegrain.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
