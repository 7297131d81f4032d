"""Registry of queries: each has a name, the Spark side, and mostly an equal SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from checks.fixtures import Fixtures, cte_chain


@dataclass(frozen=True)
class Query:
    name: str
    operators: str
    run: Callable[[Fixtures], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(operators: str, oracle: str | None = None):
    """Register a function of the fixtures under its own name.

    ``operators`` are the survey's ids; ``oracle`` may name fixtures as if they were tables.
    """

    def add(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is there already")
        QUERIES[fn.__name__] = Query(fn.__name__, operators, fn, cte_chain(oracle) if oracle else None)
        return fn

    return add


# Pieces of SQL used by many texts.
GB = "CAST(SUM(size_in_bytes) AS DOUBLE) / 1073741824"
DONE = "('COMPLETED', 'VALIDATED')"
FAILED = "('FAILED', 'FAILED_PERMANENT', 'VALIDATION_FAILED')"
ACTIVE = "('ASSIGNED', 'IN_PROGRESS')"
OPEN = "('QUEUED', 'ASSIGNED', 'IN_PROGRESS')"
RETRYABLE = "('FAILED', 'RETRY_PENDING', 'VALIDATION_FAILED')"


def count_if(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"
