"""Operators for preparing training text, with their queries in ``queries.py``."""
