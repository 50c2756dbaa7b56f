"""The data flows: documents to tables, and JSON files to documents."""
