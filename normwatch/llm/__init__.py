"""Operators for preparing text corpora at scale, with their queries and SQL."""
