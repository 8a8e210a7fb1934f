"""Readers, writers and message formats."""
