"""PySpark-native engine for weblog archives: ingestion, counting, curation, sampling, auditing and prompts."""
