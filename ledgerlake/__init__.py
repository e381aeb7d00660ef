"""Medallion analytics for a retail-banking data platform, written for Spark."""

__version__ = "0.1.0"
