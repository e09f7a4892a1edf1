"""Pollstone: survey analytics on Spark, from raw files to business tables."""

from pollstone.session import build_session

__all__ = ["build_session"]
