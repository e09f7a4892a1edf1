"""Readers and writers: raw files, service payloads, database tables, table folders."""
