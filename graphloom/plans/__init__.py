"""Pipelines, method registry and the facade."""
