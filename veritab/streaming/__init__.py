"""Structured Streaming entry points for the per-row operators (validation, scoring, category counts)."""
