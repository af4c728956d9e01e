"""Weather-station observations on Spark: BADC-CSV ingest, sorted Parquet output, queries and validation."""
