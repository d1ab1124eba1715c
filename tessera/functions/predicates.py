"""The filter algebra: a small tree of conditions, lowered to Spark columns, fail-closed."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.errors import QueryError
from tessera.functions.types import canonical_uuid
from tessera.schema import Resource

log = logging.getLogger(__name__)


class Condition:
    """A node of a filter; combine with ``&``, ``|`` and ``~``."""

    def __and__(self, other: Condition) -> Condition:
        return Both("and", (self, other))

    def __or__(self, other: Condition) -> Condition:
        return Both("or", (self, other))

    def __invert__(self) -> Condition:
        return Not(self)


@dataclass(frozen=True)
class Both(Condition):
    op: str
    parts: tuple[Any, ...]


@dataclass(frozen=True)
class Not(Condition):
    part: Any


@dataclass(frozen=True)
class Always(Condition):
    value: bool = True


@dataclass(frozen=True)
class Leaf(Condition):
    name: str
    op: str
    value: Any = None


@dataclass(frozen=True)
class Attr:
    """An attribute's name with operators that make leaves."""

    name: str

    def __eq__(self, value: Any) -> Condition:  # type: ignore[override]
        return Leaf(self.name, "eq", value)

    def __ne__(self, value: Any) -> Condition:  # type: ignore[override]
        return Leaf(self.name, "not_eq", value)

    def __gt__(self, value: Any) -> Condition:
        return Leaf(self.name, "gt", value)

    def __ge__(self, value: Any) -> Condition:
        return Leaf(self.name, "gte", value)

    def __lt__(self, value: Any) -> Condition:
        return Leaf(self.name, "lt", value)

    def __le__(self, value: Any) -> Condition:
        return Leaf(self.name, "lte", value)

    def __hash__(self) -> int:
        return hash(self.name)

    def is_in(self, values: Any) -> Condition:
        return Leaf(self.name, "in", values)

    def not_in(self, values: Any) -> Condition:
        return Leaf(self.name, "not_in", values)

    def contains(self, value: str) -> Condition:
        return Leaf(self.name, "contains", value)

    def like(self, pattern: str) -> Condition:
        return Leaf(self.name, "like", pattern)

    def ilike(self, pattern: str) -> Condition:
        return Leaf(self.name, "ilike", pattern)

    def starts_with(self, value: str) -> Condition:
        return Leaf(self.name, "starts_with", value)

    def ends_with(self, value: str) -> Condition:
        return Leaf(self.name, "ends_with", value)

    def is_nil(self, value: bool = True) -> Condition:
        return Leaf(self.name, "is_nil", value)


def attr(name: str) -> Attr:
    return Attr(name)


#: Other spellings of operators.
ALIASES = {
    "==": "eq", "=": "eq", "!=": "not_eq", "<>": "not_eq", ">": "gt", "greater_than": "gt", ">=": "gte", "greater_than_or_equal": "gte",
    "<": "lt", "less_than": "lt", "<=": "lte", "less_than_or_equal": "lte", "string_starts_with": "starts_with", "string_ends_with": "ends_with",
}


def _members(value: Any) -> list:
    return list(value) if isinstance(value, list | tuple | set | frozenset | range) else [value]


def _membership(column: Column, values: list, inside: bool) -> Column:
    if not values:
        return F.lit(not inside)
    return column.isin(values) if inside else ~column.isin(values)


OPERATORS: dict[str, Callable[[Column, Any, Config], Column]] = {
    "eq": lambda c, v, _: c == v,
    "not_eq": lambda c, v, _: c != v,
    "gt": lambda c, v, _: c > v,
    "gte": lambda c, v, _: c >= v,
    "lt": lambda c, v, _: c < v,
    "lte": lambda c, v, _: c <= v,
    "in": lambda c, v, _: _membership(c, _members(v), True),
    "not_in": lambda c, v, _: _membership(c, _members(v), False),
    "contains": lambda c, v, k: c.contains(v) if k.contains_case_sensitive else F.contains(F.lower(c), F.lower(F.lit(v))),
    "like": lambda c, v, _: c.like(v),
    "ilike": lambda c, v, _: c.ilike(v),
    "starts_with": lambda c, v, _: c.startswith(v),
    "ends_with": lambda c, v, _: c.endswith(v),
    "is_nil": lambda c, v, _: c.isNull() if v else c.isNotNull(),
}


class Untranslatable(Exception):
    pass


def condition(shape: Any) -> Any:
    """A condition from its other shapes: ``(name, op, value)``, ``{name: value}`` or ``{"op", "name", "right"}``."""
    if isinstance(shape, Condition):
        return shape
    if isinstance(shape, bool):
        return Always(shape)
    if isinstance(shape, tuple) and len(shape) == 3 and isinstance(shape[0], str):
        return Leaf(*shape)
    if isinstance(shape, dict) and {"op", "name", "right"} <= shape.keys():
        right = shape["right"]
        return Leaf(shape["name"], shape["op"], right["value"] if isinstance(right, dict) and set(right) == {"value"} else right)
    if isinstance(shape, dict) and shape and all(isinstance(k, str) for k in shape):
        leaves = [Leaf(k, "eq", v) for k, v in shape.items()]
        return leaves[0] if len(leaves) == 1 else Both("and", tuple(leaves))
    return shape


def _lower(node: Any, resource: Resource, config: Config) -> Column:
    node = condition(node)
    match node:
        case Always(value):
            return F.lit(value)
        case Not(part):
            return ~_lower(part, resource, config)
        case Both(op, parts):
            if op not in ("and", "or"):
                raise Untranslatable(f"unknown connective {op!r}")
            columns = [_lower(p, resource, config) for p in parts]  # one bad part voids the whole
            out = columns[0]
            for c in columns[1:]:
                out = out & c if op == "and" else out | c
            return out
        case Leaf(name, op, value):
            found = resource.by_name.get(name)
            if found is None:
                raise Untranslatable(f"{resource.name} has no attribute {name!r}")
            make = OPERATORS.get(ALIASES.get(op, op))
            if make is None:
                raise Untranslatable(f"unknown operator {op!r}")
            if isinstance(value, Condition | Attr | Column | dict):
                raise Untranslatable(f"the right side of {name} {op} is not a value")
            if found.type == "uuid":
                value = [canonical_uuid(v) for v in value] if isinstance(value, list | tuple | set | frozenset) else canonical_uuid(value)
            if value is None and ALIASES.get(op, op) != "is_nil":
                return F.lit(None).cast("boolean")
            return make(F.col(f"`{name}`"), value, config)
    raise Untranslatable(f"not a condition: {node!r}")


def to_column(node: Any, resource: Resource, config: Config = DEFAULT) -> Column | None:
    """The column of one filter. What can't be translated raises, or is dropped with a warning where so configured."""
    try:
        return _lower(node, resource, config)
    except Untranslatable as e:
        if config.raise_on_untranslatable_filter:
            raise QueryError(f"untranslatable filter: {e}", params=node) from e
        log.warning("dropped an untranslatable filter: %s", e)
        return None


def columns_of(nodes: Iterable[Any]) -> set[str]:
    """The attributes that filters mention."""
    out: set[str] = set()
    for node in map(condition, nodes):
        match node:
            case Leaf(name):
                out.add(name)
            case Not(part):
                out |= columns_of([part])
            case Both(_, parts):
                out |= columns_of(parts)
    return out
