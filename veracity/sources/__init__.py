"""Corpus scans and sinks."""
