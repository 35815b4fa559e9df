"""Readers for landed files, the source registry, and Parquet sinks."""
