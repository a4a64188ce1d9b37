"""Operators for large text corpora meant for model training. Nothing outside this subpackage imports it."""
