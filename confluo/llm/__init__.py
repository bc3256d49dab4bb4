"""Operators for preparing training data. Nothing outside this folder imports it."""
