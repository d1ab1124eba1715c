"""Structured errors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any


class EngineError(Exception):
    """Any failure of the engine; carries the query, its parameters and the reason where known."""

    def __init__(self, message: str, *, query: str | None = None, params: Any = None, reason: BaseException | None = None):
        super().__init__(message)
        self.message, self.query, self.params, self.reason = message, query, params, reason

    def __str__(self) -> str:
        parts = [self.message]
        if self.query:
            parts.append(f"query: {self.query}")
        if self.reason:
            parts.append(f"reason: {type(self.reason).__name__}: {str(self.reason).splitlines()[0] if str(self.reason) else ''}")
        return "; ".join(parts)


class QueryError(EngineError):
    """A query can't be built or failed."""


class ConfigurationError(EngineError):
    """A resource or setting is invalid."""


@contextmanager
def wrapped(what: str, query: str | None = None, params: Any = None) -> Iterator[None]:
    """Turn Spark's exceptions into QueryError; others pass through."""
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException

    try:
        yield
    except (PySparkException, Py4JError) as e:
        raise QueryError(f"{what} failed", query=query, params=params, reason=e) from e
