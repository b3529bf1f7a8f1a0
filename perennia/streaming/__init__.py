"""Structured Streaming jobs; every sink is a folder of Parquet files, none passes the driver."""
