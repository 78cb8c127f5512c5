"""Relational operators: joins, filters, windows, data-quality checks."""
