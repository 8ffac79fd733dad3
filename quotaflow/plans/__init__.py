"""Whole runs and the registry of checked queries."""
