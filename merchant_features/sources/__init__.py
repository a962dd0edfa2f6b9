"""Parquet sources, the feature-file sink and the feature store tables."""
