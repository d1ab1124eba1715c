"""The immutable query builder; it lowers to one DataFrame, so Spark plans the whole of it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tessera import telemetry
from tessera.errors import QueryError, wrapped
from tessera.functions.predicates import Leaf, to_column
from tessera.operators import aggregates as agg
from tessera.operators.aggregates import Aggregate
from tessera.operators.calculations import Calculation, apply
from tessera.operators.offset import skip
from tessera.schema import Resource
from tessera.sources.repo import Repo

#: Sort orders; without a word about nulls they come last.
ORDERS = {
    "asc": lambda c: c.asc_nulls_last(), "desc": lambda c: c.desc_nulls_last(), "asc_nils_first": lambda c: c.asc_nulls_first(), "asc_nils_last": lambda c: c.asc_nulls_last(),
    "desc_nils_first": lambda c: c.desc_nulls_first(), "desc_nils_last": lambda c: c.desc_nulls_last(),
}


def _count(value: Any, what: str) -> int:
    try:
        n = int(value) if not isinstance(value, bool | float) else None
    except (TypeError, ValueError):
        n = None
    if n is None or n < 0:
        raise QueryError(f"{what} must be a number of rows, not {value!r}")
    return n


@dataclass(frozen=True)
class Query:
    """What to read of a resource. Every method returns a new query."""

    resource: Resource
    filters: tuple[Any, ...] = ()
    sorts: tuple[tuple[str, str], ...] = ()
    selected: tuple[str, ...] | None = None
    is_distinct: bool = False
    grouped: tuple[str, ...] = ()
    group_aggregates: tuple[Aggregate, ...] = ()
    limited: int | None = None
    skipped: int | None = None
    aggregates: tuple[Aggregate, ...] = ()
    calculations: tuple[Calculation, ...] = ()
    tenant: Any = None
    context: dict[str, Any] = field(default_factory=dict)

    # ---- building

    def filter(self, *conditions: Any) -> Query:
        """Conditions that all must hold, with those before."""
        return replace(self, filters=self.filters + conditions)

    def sort(self, *keys: Any) -> Query:
        """Names or (name, order); a later call's keys come before an earlier one's."""
        made = tuple((k, "asc") if isinstance(k, str) else (k[0], k[1]) for k in keys)
        for name, order in made:
            self._known(name)
            if order not in ORDERS:
                raise QueryError(f"unknown sort order {order!r}")
        return replace(self, sorts=made + self.sorts)

    def select(self, *names: str) -> Query:
        """Replaces what was selected before."""
        return replace(self, selected=tuple(dict.fromkeys(map(self._known, names))))

    def distinct(self, *names: str) -> Query:
        """Distinct rows over what is selected and ``names``."""
        return replace(self, is_distinct=True, selected=tuple(dict.fromkeys((*(self.selected or ()), *map(self._known, names)))) or None)

    def group_by(self, *names: str, aggregates: tuple[Aggregate, ...] = ()) -> Query:
        return replace(self, grouped=tuple(map(self._known, names)), group_aggregates=tuple(aggregates))

    def limit(self, n: Any) -> Query:
        return replace(self, limited=_count(n, "limit"))

    def offset(self, n: Any) -> Query:
        return replace(self, skipped=_count(n, "offset"))

    def page(self, n: Any, offset: Any = 0) -> Query:
        """A page under a total order: the primary key breaks ties."""
        keys = [k for k in self.resource.keys if k not in {name for name, _ in self.sorts}]
        if not self.resource.keys:
            raise QueryError(f"{self.resource.name} has no primary key to page by")
        return replace(self, sorts=self.sorts + tuple((k, "asc") for k in keys)).limit(n).offset(offset)

    def set_tenant(self, tenant: Any) -> Query:
        """Under attribute tenancy also a filter on the tenant's attribute."""
        out = replace(self, tenant=tenant)
        if self.resource.tenancy == "attribute" and self.resource.tenant_attribute:
            out = out.filter(Leaf(self.resource.tenant_attribute, "eq", tenant))
        return out

    def set_context(self, context: dict[str, Any]) -> Query:
        return replace(self, context=self.context | context)

    def aggregate(self, *aggregates: Aggregate) -> Query:
        """A value of related rows for each record."""
        return replace(self, aggregates=self.aggregates + aggregates)

    def calculate(self, *calculations: Calculation) -> Query:
        return replace(self, calculations=self.calculations + calculations)

    def lock(self, *kind: Any) -> Query:
        """Reads take no locks: the query as it is."""
        return self

    def _known(self, name: str) -> str:
        if name not in self.resource.by_name:
            raise QueryError(f"{self.resource.name} has no attribute {name!r}")
        return name

    # ---- lowering

    def rows(self, repo: Repo) -> DataFrame:
        """The filtered rows with all columns: base filter, tenant and filters."""
        out = repo.scan(self.resource)
        for f in ((self.resource.base_filter,) if self.resource.base_filter is not None else ()) + self.filters:
            if (column := to_column(f, self.resource, repo.config)) is not None:
                out = out.filter(column)
        return out

    def _related(self, resource: Resource) -> Query:
        """A query of a related resource under this query's tenant."""
        out = query(resource)
        return out if self.tenant is None or out.tenant is not None else out.set_tenant(self.tenant)

    def order(self) -> list[Column]:
        return [ORDERS[o](F.col(f"`{n}`")) for n, o in self.sorts]

    def to_df(self, repo: Repo) -> DataFrame:
        """Filter, distinct or group, sort, skip and limit; then calculations, related aggregates, projection.

        Calculations and related aggregates see the page only. Their inputs are read whether selected or not, and
        go with the final projection. The order is applied again after joins.
        """
        with wrapped("query"):
            out = self.rows(repo)
            if self.grouped:
                out = agg.groups(out, self.resource, self.grouped, self.group_aggregates, repo.config)
                return self._cut(out, [k for k in self.sorts if k[0] in out.columns])
            final = list(self.selected or [a.name for a in self.resource.attributes])
            if self.is_distinct:
                hidden = [n for n, _ in self.sorts if n not in final]
                out = self._cut(out.select(*final, *hidden).distinct(), self.sorts)
            else:
                out = self._cut(out, self.sorts)
            before = set(out.columns)
            out = apply(out, list(self.calculations))
            made = [c.name for c in self.calculations if c.name in out.columns and (c.name not in before or c.name not in final)]
            if self.aggregates:
                out = agg.attach(out, self.resource, self.aggregates, lambda r: self._related(r).rows(repo), repo.config, self.limited is not None and self.limited <= agg.PAGE)
                if self.sorts:
                    out = out.orderBy(*self.order())
            return out.select(*final, *[m for m in dict.fromkeys(made) if m not in final], *[a.name for a in self.aggregates])

    def _cut(self, out: DataFrame, sorts: Any) -> DataFrame:
        """Sort, skip and limit. Spark skips in one task: beyond a page the first rows are filtered out before the sort.

        A sort by computed values of groups stays with Spark, as sums of doubles may differ from run to run.
        """
        deep = self.skipped and sorts and (self.limited is None or self.skipped + self.limited > agg.PAGE)
        deep = deep and (not self.grouped or {n for n, _ in sorts} <= set(self.grouped))
        if deep:
            keys: dict[str, str] = {}
            for name, order in (*sorts, *((g, "asc") for g in self.grouped)):
                keys.setdefault(name, order)
            out = skip(out, list(keys.items()), self.skipped, ORDERS)
        if sorts:
            out = out.orderBy(*[ORDERS[o](F.col(f"`{n}`")) for n, o in sorts])
        if self.skipped and not deep:
            out = out.offset(self.skipped)
        return out if self.limited is None else out.limit(self.limited)

    # ---- running

    def run(self, repo: Repo) -> list[Row]:
        with telemetry.span("tessera.run_query", resource=self.resource.name, query=self), wrapped("query"):
            return self.to_df(repo).collect()

    def records(self, repo: Repo) -> list[dict[str, Any]]:
        """Full records: attributes that were not selected are None, aggregates lie under ``aggregates``."""
        named = {a.name for a in self.aggregates}
        out = []
        for row in self.run(repo):
            values = row.asDict()
            record = {a.name: values.get(a.name) for a in self.resource.attributes} | {k: v for k, v in values.items() if k not in named}
            out.append(record | {"aggregates": {k: values[k] for k in values if k in named}})
        return out

    def aggregate_values(self, repo: Repo, *aggregates: Aggregate) -> dict[str, Any]:
        """Aggregates over the filtered rows; sort, page, selection and distinct don't matter."""
        if not aggregates:
            return {}
        with telemetry.span("tessera.aggregate", resource=self.resource.name), wrapped("aggregate"):
            return self.aggregate_df(repo, *aggregates).head().asDict()

    def aggregate_df(self, repo: Repo, *aggregates: Aggregate) -> DataFrame:
        return agg.over_rows(self.rows(repo), self.resource, aggregates, repo.config)


def query(resource: Resource) -> Query:
    """A query of the resource with its default context; a tenant in it filters as ``set_tenant`` does."""
    out = Query(resource, context=dict(resource.default_context))
    tenant = resource.default_context.get("tenant")
    return out if tenant is None else out.set_tenant(tenant)


def stream(q: Query, repo: Repo, prefetch: bool = True) -> Iterator[Row]:
    """The query's rows one by one; the driver holds a partition at a time (two with prefetch)."""
    with telemetry.span("tessera.stream", resource=q.resource.name), wrapped("stream"):
        yield from q.to_df(repo).toLocalIterator(prefetchPartitions=prefetch)
