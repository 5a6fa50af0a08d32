"""Readers: driver-table mapping, commit-log replay, views, inline rows, catalog metadata."""
