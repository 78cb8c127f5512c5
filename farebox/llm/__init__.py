"""Operators for preparing training data; see the module docstrings."""
