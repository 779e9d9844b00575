"""Operators for preparing text at corpus scale. Nothing outside this package imports it."""
