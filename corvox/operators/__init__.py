"""Operators: alignment, rule engines, reports, integrity and signal metrics."""
