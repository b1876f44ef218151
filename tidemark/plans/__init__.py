"""Registered queries, by area."""

from importlib import import_module

AREAS = ["feed", "messages", "items", "catalogue", "assembly", "documents", "values", "streams"]


def load() -> None:
    """Import every area so its queries are registered."""
    for area in AREAS:
        import_module(f"tidemark.plans.{area}")
