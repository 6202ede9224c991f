"""Service-request analytics on Spark: ingest, clean, star schema, metric views."""
