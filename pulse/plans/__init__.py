"""Table bundles, storage of table versions, and the batch jobs."""
