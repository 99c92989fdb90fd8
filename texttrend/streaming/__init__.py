"""Incremental versions of the trend operators."""
