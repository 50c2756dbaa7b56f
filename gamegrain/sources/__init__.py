"""Scans: document feeds with explicit schemas, file inventories, inline lookups."""
