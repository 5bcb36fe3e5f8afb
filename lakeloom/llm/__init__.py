"""Operators for preparing training text; nothing outside imports this package."""
