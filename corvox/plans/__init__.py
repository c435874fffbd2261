"""Registered queries, one per operator, with their SQL."""
