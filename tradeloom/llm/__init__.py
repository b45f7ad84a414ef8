"""Operators for preparing training text; nothing else in the repository imports this package."""
