"""Operators for preparing training data: filters, duplicate removal, scoring and encoding."""
