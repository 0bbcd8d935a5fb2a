"""Readers: files, tables, streams, generators."""
