"""Operators: silver cleaning, dedupe, data-quality checks, gold aggregates and
distributed ranking (NTILE / RANK without single-task windows)."""
