"""DataFrame -> DataFrame operators: metrics, ranking, views, reports, ingest, quality."""
