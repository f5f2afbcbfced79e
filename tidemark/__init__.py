"""tidemark: reconciliation, routing and incremental ingest expressed as Spark plans."""
