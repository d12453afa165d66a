"""Readers for message streams, config tables and dimensions."""
