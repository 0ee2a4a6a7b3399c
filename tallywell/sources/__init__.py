"""Readers and writers: survey tables and data dictionaries."""
