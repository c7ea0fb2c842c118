"""Parquet table writers, the load log, the sweep and catalog registration."""
