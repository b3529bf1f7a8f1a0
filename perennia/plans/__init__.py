"""Whole analytics: lifetime value under its policies, reports, and the ingest job."""
