"""Sources and sinks: schemas, raw-file ingestion, fixture views, exports."""
