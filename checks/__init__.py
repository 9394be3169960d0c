"""Registered queries and their independent SQL, over the shared star-schema tables."""

from __future__ import annotations


def load() -> dict:
    """Every registered query by name."""
    from . import queries_pixels, queries_tables  # noqa: F401
    from .registry import QUERIES

    return QUERIES
