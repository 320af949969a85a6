"""Corporate-card analytics on Spark: curation, star schema, marts, data quality, ingestion."""
