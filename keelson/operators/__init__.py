"""Relational building blocks: merge, enrichment join, key checks, summaries."""
