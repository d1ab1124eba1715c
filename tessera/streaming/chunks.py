"""Incremental delivery of a query's result in chunks of records."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

from pyspark.sql import Row

from tessera.errors import QueryError
from tessera.plans.query import Query, stream
from tessera.sources.repo import Repo


def chunks(query: Query, repo: Repo, size: int = 1000) -> Iterator[tuple[Row, ...]]:
    """Tuples of at most ``size`` rows, in the query's order; calculations and aggregates are part of the rows."""
    if size < 1:
        raise QueryError(f"chunk size must be positive, not {size!r}")
    yield from batched(stream(query, repo), size, strict=False)
