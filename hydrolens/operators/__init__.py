"""Row and group operators: ingest, latest row, alerts."""
