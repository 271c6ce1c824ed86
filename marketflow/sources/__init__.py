"""Readers: landed payloads, raw tables, seeds and the driver-table fixtures."""
