"""Catalogue change-data engine expressed as DataFrame and Structured Streaming programs."""

from tidemark.api import Catalogue
from tidemark.operators.criteria import Criteria

__all__ = ["Catalogue", "Criteria"]
