"""Warehouse jobs: feeds to canonical rows, history, star schema, reports."""
