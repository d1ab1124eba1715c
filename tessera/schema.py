"""Declared resources: attributes, relationships, tenancy and physical options."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

from pyspark.sql import types as T

from tessera import identifiers
from tessera.errors import ConfigurationError
from tessera.functions.types import is_composite, spark_type

INDEX_TYPES = ("minmax", "set", "bloom_filter", "ngrambf_v1", "tokenbf_v1")


@dataclass(frozen=True)
class Attribute:
    """A typed column. ``default`` is a value, or a function that makes one on insert."""

    name: str
    type: Any = "string"
    nullable: bool = True
    primary_key: bool = False
    default: Any = None
    constraints: dict[str, Any] = field(default_factory=dict)

    def field(self) -> T.StructField:
        logical = self.type if isinstance(self.type, str) else repr(self.type)
        return T.StructField(self.name, spark_type(self.type, self.constraints), self.nullable and not self.primary_key, {"logical": logical, "primary_key": self.primary_key})


@dataclass(frozen=True)
class Relationship:
    """``kind``: belongs_to (source holds the key), has_many or has_one (destination holds it)."""

    name: str
    kind: str
    destination: Callable[[], Resource] | Resource
    source_attribute: str
    destination_attribute: str

    def __post_init__(self):
        if self.kind not in ("belongs_to", "has_many", "has_one"):
            raise ConfigurationError(f"unknown kind of relationship: {self.kind!r}")

    @property
    def target(self) -> Resource:
        return self.destination if isinstance(self.destination, Resource) else self.destination()


@dataclass(frozen=True)
class Index:
    name: str
    expression: str
    type: str = "minmax"
    granularity: int = 1


@dataclass(frozen=True)
class Resource:
    """A table as declared: what it holds, how it is laid out, and what every read of it is filtered by."""

    name: str
    attributes: tuple[Attribute, ...]
    relationships: tuple[Relationship, ...] = ()
    table: str | None = None
    database: str | None = None
    domain: str | None = None
    base_filter: Any = None
    default_context: dict[str, Any] = field(default_factory=dict)
    tenancy: str | None = None
    tenant_attribute: str | None = None
    engine: str = "MergeTree()"
    order_by: tuple[str, ...] = ()
    partition_by: str | None = None
    primary_key: tuple[str, ...] = ()
    settings: str | None = None
    indexes: tuple[Index, ...] = ()
    insert_options: dict[str, Any] = field(default_factory=dict)
    mutations_sync: int = 1
    migrate: bool = True
    description: str | None = None

    def __post_init__(self):
        identifiers.checked(self.table_name, "table name")
        if self.database is not None:
            identifiers.checked(self.database, "database name")
        names = [a.name for a in self.attributes]
        if len(set(names)) < len(names):
            raise ConfigurationError(f"{self.name}: attribute names repeat")
        if self.tenancy not in (None, "attribute", "context"):
            raise ConfigurationError(f"{self.name}: unknown tenancy {self.tenancy!r}")
        seen = set()
        for i in self.indexes:
            if not i.name or not i.expression:
                raise ConfigurationError(f"{self.name}: an index needs a name and an expression")
            if i.type.partition("(")[0] not in INDEX_TYPES:
                raise ConfigurationError(f"{self.name}: unknown index type {i.type!r}")
            if i.name in seen:
                raise ConfigurationError(f"{self.name}: index {i.name!r} is declared twice")
            seen.add(i.name)

    @property
    def table_name(self) -> str:
        """The declared table, else the last part of the name (with a domain: the last two, joined by ``_``)."""
        if self.table:
            return self.table
        parts = [re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", p).lower() for p in self.name.split(".")]
        return "_".join(parts[-2:]) if self.domain and len(parts) > 1 else parts[-1]

    @cached_property
    def by_name(self) -> dict[str, Attribute]:
        return {a.name: a for a in self.attributes}

    @property
    def keys(self) -> tuple[str, ...]:
        return tuple(a.name for a in self.attributes if a.primary_key)

    @property
    def layout_keys(self) -> tuple[str, ...]:
        """What rows are sorted by within files: declared, else the primary key, else nothing."""
        return self.order_by or self.keys

    def schema(self) -> T.StructType:
        return T.StructType([a.field() for a in self.attributes])

    def relationship(self, name: str) -> Relationship | None:
        return next((r for r in self.relationships if r.name == name), None)

    def check_nullability(self) -> None:
        """Arrays, maps and tuples may not be nullable in the strict contract."""
        for a in self.attributes:
            if a.nullable and not a.primary_key and is_composite(a.type):
                raise ConfigurationError(f"{self.name}.{a.name}: a composite column can't be nullable")
