"""Operators: cleaning rules, metrics and data-quality checks."""
