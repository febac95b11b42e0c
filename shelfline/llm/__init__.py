"""Operators for building text training data at scale."""
