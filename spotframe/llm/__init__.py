"""Operators for preparing training text: extraction, deduplication, filtering, archives and tokens.

Nothing else in the library imports this subpackage.
"""
