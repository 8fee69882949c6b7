"""Structured Streaming drivers."""
