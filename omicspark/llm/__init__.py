"""Operators of a large training-data pipeline. Nothing outside this subpackage imports it."""
