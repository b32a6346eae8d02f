"""Readers and writers of pages, events, graph records and graph tables."""
