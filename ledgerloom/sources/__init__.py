"""Readers and writers for the raw, clean and business layers."""
