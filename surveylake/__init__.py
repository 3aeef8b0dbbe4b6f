"""Survey-lake analytics on Spark: ingest, harmonise, aggregate and compare survey editions."""
