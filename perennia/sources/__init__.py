"""Event sources: JSON array files, JSON lines, the Parquet event log and star-schema adapters."""
