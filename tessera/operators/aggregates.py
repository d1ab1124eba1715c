"""Aggregates over a query, and per record across relationships."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.errors import EngineError, QueryError
from tessera.functions.predicates import to_column
from tessera.schema import Resource

log = logging.getLogger(__name__)

KINDS = ("count", "sum", "avg", "min", "max")
#: Records of a page whose keys are sent to the related rows before these are grouped.
PAGE = 10_000


@dataclass(frozen=True)
class Aggregate:
    """``path`` names the relationships to follow; ``filter`` restricts the rows that count; ``default`` fills none."""

    name: str
    kind: str
    field: str | None = None
    path: tuple[str, ...] = ()
    filter: Any = None
    default: Any = None


def expression(a: Aggregate, resource: Resource, config: Config = DEFAULT) -> Column:
    """The aggregate's column over rows of ``resource``; a filter becomes a conditional aggregate."""
    if a.kind not in KINDS:
        raise QueryError(f"aggregate kind {a.kind!r} is not supported")
    if a.field is None and a.kind != "count":
        raise QueryError(f"aggregate {a.name}: {a.kind} needs a field")
    if a.field is not None and a.field not in resource.by_name:
        raise QueryError(f"aggregate {a.name}: {resource.name} has no attribute {a.field!r}")
    value = F.lit(1) if a.field is None else F.col(f"`{a.field}`")
    if a.filter is not None and (kept := to_column(a.filter, resource, config)) is not None:
        value = F.when(kept, value)
    return getattr(F, a.kind)(value)


def _filled(column: Column, default: Any) -> Column:
    return column if default is None else F.coalesce(column, F.lit(default))


def over_rows(rows: DataFrame, resource: Resource, aggregates: Iterable[Aggregate], config: Config = DEFAULT) -> DataFrame:
    """One row: all aggregates in one pass."""
    columns = [_filled(expression(a, resource, config), a.default).alias(a.name) for a in aggregates]
    return rows.agg(*columns) if columns else rows.sparkSession.createDataFrame([{}], "struct<>").limit(1)


def groups(rows: DataFrame, resource: Resource, by: Iterable[str], aggregates: Iterable[Aggregate] = (), config: Config = DEFAULT) -> DataFrame:
    """The grouping columns, with aggregates where there are some, else distinct."""
    by, aggregates = list(by), list(aggregates)
    for name in by:
        if name not in resource.by_name:
            raise QueryError(f"{resource.name} has no attribute {name!r}")
    if not aggregates:
        return rows.select(*by).distinct()
    return rows.groupBy(*by).agg(*[_filled(expression(a, resource, config), a.default).alias(a.name) for a in aggregates])


def _route(resource: Resource, a: Aggregate) -> tuple[Resource, str, str] | None:
    """(related resource, key of the record, key of the related rows), or None where only the default applies."""
    if len(a.path) > 1:
        return None
    if not a.path:
        return (resource, resource.keys[0], resource.keys[0]) if len(resource.keys) == 1 else None
    found = resource.relationship(a.path[0])
    if found is None:
        raise QueryError(f"{resource.name} has no relationship {a.path[0]!r}")
    if found.kind == "belongs_to" and len(found.target.keys) > 1:
        return None
    return found.target, found.source_attribute, found.destination_attribute


def attach(records: DataFrame, resource: Resource, aggregates: Iterable[Aggregate], rows_of: Callable[[Resource], DataFrame], config: Config = DEFAULT, is_page: bool = False) -> DataFrame:
    """``records`` with a column for each aggregate; of a page (``PAGE`` records at most) only the related rows are grouped.

    Aggregates that follow the same route share one grouping of the related rows and one left join; Spark
    combines on the map side and broadcasts a grouped side that is small. Without related rows, over several
    hops, and where the related table has a composite key, the default stands.
    """
    aggregates = list(aggregates)
    by_route: dict[tuple, list[Aggregate]] = defaultdict(list)
    out, kinds = records, {}
    for a in aggregates:
        if a.kind not in KINDS:
            raise QueryError(f"aggregate kind {a.kind!r} is not supported")
        route = _route(resource, a)
        by_route[(None if route is None else (a.path, *route[1:]))].append(a)
        kinds[a.name] = route
    for key, members in by_route.items():
        if key is None:
            out = out.withColumns({a.name: F.lit(a.default) for a in members})
            continue
        related, source, destination = kinds[members[0].name]
        try:
            rows = rows_of(related)
            if is_page:
                keys = records.select(F.col(f"`{source}`").alias("__wanted")).distinct()  # as many as the page's limit
                rows = rows.join(F.broadcast(keys), F.col(f"`{destination}`") == F.col("__wanted"), "left_semi")
            sums = rows.groupBy(F.col(f"`{destination}`").alias("__key")).agg(*[expression(a, related, config).alias(a.name) for a in members])
            out = out.join(sums, out[source] == sums["__key"], "left").drop("__key").withColumns({a.name: _filled(F.col(a.name), a.default) for a in members})
        except EngineError:
            if config.raise_on_aggregate_failure:
                raise
            log.warning("aggregates %s failed; their defaults stand", [a.name for a in members])
            out = out.withColumns({a.name: F.lit(a.default) for a in members})
    return out.select(*[c for c in out.columns if c not in kinds], *[a.name for a in aggregates])
