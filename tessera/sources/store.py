"""Versioned Parquet tables: appends, copy-on-write updates and deletes.

A table is a folder of segments (Parquet folders that Spark wrote) and of versions, each a small JSON file that
lists the segments of one state. An insert writes a new segment and a version that lists it as well. An update or
delete rewrites only the segments that hold matching rows. A version file is created under its number without
overwriting, so of two writers that started from one version the second fails and readers see whole states only.
Everything goes through Hadoop's file system, so tables can lie in any store that Spark reaches.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable
from itertools import batched
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import identifiers, telemetry
from tessera.config import DEFAULT, Config
from tessera.errors import QueryError, wrapped
from tessera.functions.predicates import Always, Both, Leaf, condition, to_column
from tessera.functions.types import decode
from tessera.plans.ddl import partition
from tessera.plans.query import Query
from tessera.schema import Attribute, Resource
from tessera.sources.repo import CatalogRepo, Repo

log = logging.getLogger(__name__)


class Files:
    """The little of Hadoop's file system that versions need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.path = lambda p: self.jvm.org.apache.hadoop.fs.Path(p)
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, file: str, text: str) -> None:
        """Created without overwriting, so of two writers one fails."""
        try:
            out = self.fs.create(self.path(file), False)
        except Exception as e:
            raise QueryError(f"{file} was written by another writer") from e
        try:
            out.write(bytearray(text.encode()))
            out.hsync()
        finally:
            out.close()

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


class StoreRepo(Repo):
    """Resources as versioned tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str, config: Config = DEFAULT):
        super().__init__(spark, config)
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)

    # ---- versions

    def folder(self, resource: Resource) -> str:
        return "/".join([self.root, *([resource.database] if resource.database else []), resource.table_name])

    def version(self, resource: Resource) -> tuple[int, list[str]]:
        """(number, segments) of the current version; 0 where the table doesn't exist."""
        found = [int(n[:-5]) for n in self.files.names(f"{self.folder(resource)}/versions") if n.endswith(".json")]
        return (max(found), json.loads(self.files.read(f"{self.folder(resource)}/versions/{max(found):012d}.json"))["segments"]) if found else (0, [])

    def exists(self, resource: Resource) -> bool:
        return self.version(resource)[0] > 0

    def create(self, resource: Resource) -> None:
        """An empty first version, unless there is one."""
        if self.config.strict_nullability:
            resource.check_nullability()
        if not self.exists(resource):
            self._commit(resource, 0, [])

    def drop(self, resource: Resource) -> None:
        self.files.delete(self.folder(resource))

    def _commit(self, resource: Resource, was: int, segments: list[str]) -> None:
        self.files.create(f"{self.folder(resource)}/versions/{was + 1:012d}.json", json.dumps({"segments": segments}))

    def _segment(self, resource: Resource, segment: str) -> DataFrame:
        return self.spark.read.schema(resource.schema()).parquet(f"{self.folder(resource)}/{segment}")

    def _write(self, resource: Resource, rows: DataFrame) -> str:
        """A new segment, sorted within files by the layout keys; bloom filters where indexes ask for them."""
        segment = f"segment-{uuid.uuid4().hex}"
        if resource.layout_keys:
            rows = rows.sortWithinPartitions(*resource.layout_keys)
        writer = rows.write
        for index in resource.indexes:
            if index.type.startswith("bloom_filter") and index.expression in resource.by_name:
                writer = writer.option(f"parquet.bloom.filter.enabled#{index.expression}", "true")
        writer.parquet(f"{self.folder(resource)}/{segment}")
        return segment

    def scan(self, resource: Resource) -> DataFrame:
        version, segments = self.version(resource)
        if not version:
            raise QueryError(f"no table {resource.table_name!r}")
        if not segments:
            return self.spark.createDataFrame([], resource.schema())
        return self.spark.read.schema(resource.schema()).parquet(*[f"{self.folder(resource)}/{s}" for s in segments])

    # ---- inserts

    def insert_frame(self, resource: Resource, rows: DataFrame) -> None:
        """Append a frame as one segment; columns by name, missing ones filled from defaults or null."""
        with telemetry.span("tessera.insert", resource=resource.name), wrapped("insert"):
            self.create(resource)
            was, segments = self.version(resource)
            self._commit(resource, was, [*segments, self._write(resource, typed(resource, rows))])

    def insert(self, resource: Resource, values: dict[str, Any]) -> dict[str, Any]:
        """Insert one record and return it with its keys and defaults."""
        return self.bulk_insert(resource, [values])[0]

    def bulk_insert(self, resource: Resource, records: Iterable[dict[str, Any]], batch_size: int | None = None, return_records: bool = True, **ignored: Any) -> list[dict[str, Any]]:
        """Insert records in batches, each one version; a failing batch ends it and earlier ones stay.

        ``async_insert``, ``wait_for_async_insert`` and the like are accepted and ignored.
        """
        size = min(batch_size or self.config.insert_batch, self.config.insert_batch_most)
        if size < 1:
            raise QueryError(f"batch size must be positive, not {size!r}")
        done: list[dict[str, Any]] = []
        with telemetry.span("tessera.insert", resource=resource.name), wrapped("insert"):
            self.create(resource)
            for part in batched(records, size, strict=False):
                full = [complete(resource, r) for r in part]
                rows = self.spark.createDataFrame([tuple(r[a.name] for a in resource.attributes) for r in full], resource.schema())
                was, segments = self.version(resource)
                self._commit(resource, was, [*segments, self._write(resource, rows)])
                if return_records:
                    done += full
        return done

    # ---- mutations

    def _mutate(self, resource: Resource, where: Any, change) -> None:
        """Rewrite the segments that hold matching rows; ``change`` maps (rows, predicate) to the new rows."""
        predicate = to_column(where, resource, self.config)
        if predicate is None:
            raise QueryError("a mutation's filter can't be dropped", params=where)
        if resource.base_filter is not None:
            predicate = predicate & to_column(resource.base_filter, resource, self.config)
        hit = F.coalesce(predicate, F.lit(False))  # where it is unknown, the row stays as it is
        was, segments = self.version(resource)
        if not segments:
            return
        file = F.input_file_name()
        touched = {r[0] for r in self.scan(resource).withColumn("__segment", F.regexp_extract(file, r"(segment-[0-9a-f]{32})", 1)).where(hit).select("__segment").distinct().collect()}  # at most a row a segment
        rewritten = [s for s in segments if s in touched]
        if not rewritten:
            return
        rows = self.spark.read.schema(resource.schema()).parquet(*[f"{self.folder(resource)}/{s}" for s in rewritten])
        self._commit(resource, was, [*[s for s in segments if s not in touched], self._write(resource, change(rows, hit))])

    def update_where(self, resource: Resource, where: Any, changes: dict[str, Any]) -> None:
        """Set literal values in the rows that match; ``Always(True)`` says all on purpose."""
        self._refuse_empty(where, "update")
        for name in changes:
            if name not in resource.by_name:
                raise QueryError(f"{resource.name} has no attribute {name!r}")
        if not changes:
            return
        with telemetry.span("tessera.update", resource=resource.name), wrapped("update"):
            literals = {name: _literal(resource, resource.by_name[name], value) for name, value in changes.items()}
            new = lambda a, hit: F.when(hit, literals[a.name]).otherwise(F.col(f"`{a.name}`")).alias(a.name) if a.name in changes else F.col(f"`{a.name}`")
            self._mutate(resource, where, lambda rows, hit: rows.select(*[new(a, hit) for a in resource.attributes]))

    def delete_where(self, resource: Resource, where: Any) -> None:
        self._refuse_empty(where, "delete")
        with telemetry.span("tessera.delete", resource=resource.name), wrapped("delete"):
            self._mutate(resource, where, lambda rows, hit: rows.where(~hit))

    def update(self, resource: Resource, record: dict[str, Any], changes: dict[str, Any], filter: Any = None, **ignored: Any) -> dict[str, Any]:
        """Update the row with the record's primary key; without changes nothing runs."""
        if changes:
            self.update_where(resource, self._by_key(resource, record, filter), changes)
        return record | changes

    def destroy(self, resource: Resource, record: dict[str, Any], filter: Any = None, **ignored: Any) -> None:
        self.delete_where(resource, self._by_key(resource, record, filter))

    def update_query(self, query: Query, changes: dict[str, Any]) -> DataFrame:
        """Update what the query matches, then read it again: rows that stopped matching are not returned."""
        self._whole(query, "update")
        self.update_where(query.resource, _all_of(query.filters), changes)
        return query.to_df(self)

    def destroy_query(self, query: Query) -> None:
        self._whole(query, "delete")
        self.delete_where(query.resource, _all_of(query.filters))

    def _whole(self, query: Query, what: str) -> None:
        """A mutation takes a query's filters alone, so one that says which or how many of the rows is refused."""
        if query.limited is not None or query.skipped or query.is_distinct or query.grouped:
            raise QueryError(f"refused to {what} by a query with a limit, offset, distinct or groups; it would change all rows that match the filters")

    def _by_key(self, resource: Resource, record: dict[str, Any], filter: Any) -> Any:
        keys = {k: record[k] for k in resource.keys if record.get(k) is not None}
        if not keys or len(keys) < len(resource.keys):
            raise QueryError(f"{resource.name}: the primary key is missing", params=record)
        return _all_of((*[Leaf(k, "eq", v) for k, v in keys.items()], *([filter] if filter is not None else [])))

    def _refuse_empty(self, where: Any, what: str) -> None:
        if where is None or (isinstance(condition(where), Both) and not condition(where).parts):
            raise QueryError(f"refused to {what} every row; pass Always(True) to mean it")

    def vacuum(self, resource: Resource) -> None:
        """Drop old versions and the segments that only they list; for times without readers of those."""
        number, live = self.version(resource)
        for n in self.files.names(self.folder(resource)):
            if n.startswith("segment-") and n not in live:
                self.files.delete(f"{self.folder(resource)}/{n}")
        for n in self.files.names(f"{self.folder(resource)}/versions"):
            if n != f"{number:012d}.json":
                self.files.delete(f"{self.folder(resource)}/versions/{n}")


class CatalogStore(CatalogRepo):
    """The catalog's tables, as migrations make them, with appends: the repository to migrate, write and read by.

    A derived partition column (the month of a date) is computed on write.
    """

    def insert_frame(self, resource: Resource, rows: DataFrame) -> None:
        with telemetry.span("tessera.insert", resource=resource.name), wrapped("insert"):
            out, parted = typed(resource, rows), partition(resource)
            if parted and parted[0] not in resource.by_name:
                out = out.withColumn(parted[0], F.expr(parted[1]))
            if resource.layout_keys:
                out = out.sortWithinPartitions(*([parted[0]] if parted else []), *resource.layout_keys)
            name = identifiers.qualified(resource.table_name, resource.database or self.database)
            writer = out.write.format("parquet").mode("append")
            (writer.partitionBy(parted[0]) if parted else writer).saveAsTable(name)

    def insert(self, resource: Resource, values: dict[str, Any]) -> dict[str, Any]:
        return self.bulk_insert(resource, [values])[0]

    def bulk_insert(self, resource: Resource, records: Iterable[dict[str, Any]], batch_size: int | None = None, **ignored: Any) -> list[dict[str, Any]]:
        done: list[dict[str, Any]] = []
        for part in batched(records, min(batch_size or self.config.insert_batch, self.config.insert_batch_most), strict=False):
            full = [complete(resource, r) for r in part]
            self.insert_frame(resource, self.spark.createDataFrame([tuple(r[a.name] for a in resource.attributes) for r in full], resource.schema()))
            done += full
        return done

    def scan_month(self, resource: Resource, month: str) -> DataFrame:
        """The rows of one partition of a derived month (``yyyyMM``); Spark reads no other."""
        parted = partition(resource)
        if not parted or parted[0] in resource.by_name:
            raise QueryError(f"{resource.name} has no partition by month")
        table = self.spark.table(identifiers.qualified(resource.table_name, resource.database or self.database))
        return table.where(F.col(parted[0]) == month).select(*[identifiers.quoted(a.name) for a in resource.attributes])


def _all_of(conditions: tuple[Any, ...]) -> Any:
    return None if not conditions else conditions[0] if len(conditions) == 1 else Both("and", conditions)


def _default_column(a: Attribute):
    if a.type == "uuid" and a.primary_key and a.default is None:
        return F.expr("uuid()")
    if callable(a.default):
        raise QueryError(f"the default of {a.name} is a function, which makes values for single records only; give the column")
    return F.lit(a.default)


def typed(resource: Resource, rows: DataFrame) -> DataFrame:
    """A frame with all attributes by name and type: UUIDs in canonical form, defaults for missing columns.

    A null in a column that may not hold one fails the write.
    """

    def one(a: Attribute):
        value = F.col(f"`{a.name}`") if a.name in rows.columns else _default_column(a)
        if a.type == "uuid":
            plain = F.lower(F.regexp_replace(value.cast("string"), "[-{}]", ""))
            parts = [F.substring(plain, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
            value = F.when(plain.rlike("^[0-9a-f]{32}$"), F.concat_ws("-", *parts)).otherwise(value)
        value = value.cast(a.field().dataType)
        if not a.field().nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{resource.name}.{a.name} may not be null")).cast(a.field().dataType))
        return value.alias(a.name)

    return rows.select(*[one(a) for a in resource.attributes])


def _literal(resource: Resource, a: Attribute, value: Any):
    """A column of one value, decoded as on insert."""
    value = decode(value, a.type)
    if value is None and not a.field().nullable:
        raise QueryError(f"{resource.name}.{a.name} may not be null")
    return _made(value).cast(a.field().dataType)


def _made(value: Any):
    if isinstance(value, dict):
        return F.create_map(*[_made(x) for pair in value.items() for x in pair]) if value else F.create_map()
    if isinstance(value, list):
        return F.array(*[_made(x) for x in value])
    if isinstance(value, tuple):
        return F.struct(*[_made(x).alias(f"_{i}") for i, x in enumerate(value, 1)])
    return F.lit(value)


def complete(resource: Resource, values: dict[str, Any]) -> dict[str, Any]:
    """A record with all attributes: given values by type, defaults, generated keys, else null."""
    for name in values:
        if name not in resource.by_name:
            raise QueryError(f"{resource.name} has no attribute {name!r}")
    out = {}
    for a in resource.attributes:
        value = values.get(a.name)
        if value is None:
            value = a.default() if callable(a.default) else a.default
        if value is None and a.primary_key and a.type == "uuid":
            value = str(uuid.uuid4())
        value = decode(value, a.type)
        if value is None and not a.field().nullable:
            raise QueryError(f"{resource.name}.{a.name} may not be null", params=values)
        out[a.name] = value
    return out


__all__ = ["Always", "CatalogStore", "Files", "StoreRepo", "complete", "typed"]
