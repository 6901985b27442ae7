"""Process-history analytics on Spark: ingest, materialise, query, govern and reconcile event history."""
