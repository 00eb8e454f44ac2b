"""Micro-batch feeds."""
