"""Reusable DataFrame operators: latest-per-key, write modes, quality checks."""
