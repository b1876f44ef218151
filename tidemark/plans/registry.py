"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.fixtures import Fixtures
from tidemark.plans.oracle_views import VIEWS
from tidemark.session import configure


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Fixtures], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}
PLACEHOLDER = re.compile(r"\{([a-z_]+)\}")


def query(name: str, oracle: str | None = None) -> Callable:
    """Register a query under ``name``; ``{view}`` in the oracle names one of the derived views."""

    def register(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, oracle)
        return build

    return register


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build a registered query over the tables of one folder."""
    return REGISTRY[name].build(Fixtures(configure(spark), sf_dir))


def expand(text: str) -> str:
    """Oracle text with the views it names as common table expressions."""
    needed: list[str] = []

    def need(name: str) -> None:
        for other in PLACEHOLDER.findall(VIEWS[name]):
            need(other)
        if name not in needed:
            needed.append(name)

    for name in PLACEHOLDER.findall(text):
        need(name)
    views = [f"{name} AS ({PLACEHOLDER.sub(r'\1', VIEWS[name]).strip()})" for name in needed]
    body = PLACEHOLDER.sub(r"\1", text).strip()
    own = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if own:
        head = ", ".join([*views, ""]) if views else ""
        return f"WITH RECURSIVE {head}{body[own.end():]}"
    return f"WITH {', '.join(views)} {body}" if views else body
