"""Whole jobs: ingestion, raw to clean, clean to business tables."""
