"""Incremental processing: work backlog and file-stream ingestion."""
