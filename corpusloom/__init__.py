"""Spark-first engine for incremental document-corpus ingestion and retrieval."""
