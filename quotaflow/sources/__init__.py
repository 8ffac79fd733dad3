"""Readers, writers, catalog tables and scratch space."""
