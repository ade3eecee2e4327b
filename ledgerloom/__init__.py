"""Retail order analytics as PySpark jobs: raw files -> clean tables -> business tables -> reports."""
