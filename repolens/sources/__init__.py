"""Readers: landed JSON pages (REST / GraphQL shapes), parquet scans, catalog tables."""
