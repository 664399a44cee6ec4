"""Readers, writers and the test-table stand-ins."""

from featurewright.sources.tables import read_listing_csv, read_path, read_sql, read_table, scan  # noqa: F401
