"""Incremental processing."""
