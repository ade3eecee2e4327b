"""Operators for preparing training text: deduplication, quality, scans, mixing and output."""
