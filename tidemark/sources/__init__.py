"""Readers, writers and parsers of recorded source payloads."""
