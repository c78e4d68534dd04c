"""Table maintenance, catalog and model jobs."""
