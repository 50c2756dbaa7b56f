"""Table contracts, table maintenance on files, and the JDBC sink."""
