"""Composite jobs and fixture views."""
