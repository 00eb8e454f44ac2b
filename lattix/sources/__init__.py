"""Ingest of elements and identities."""
