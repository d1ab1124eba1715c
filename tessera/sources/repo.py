"""Where a resource's rows come from: Parquet folders, the session's catalog, or the engine's own store."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tessera import identifiers, telemetry
from tessera.config import DEFAULT, Config
from tessera.errors import QueryError, wrapped
from tessera.schema import Resource


class Repo:
    """A session with settings; subclasses say how a resource is scanned."""

    def __init__(self, spark: SparkSession, config: Config = DEFAULT, database: str | None = None):
        self.spark, self.config, self.database = spark, config, database

    def scan(self, resource: Resource) -> DataFrame:
        """All rows, with the declared columns only."""
        raise NotImplementedError

    def query(self, sql: str, params: Sequence[Any] | dict[str, Any] = (), tables: dict[str, Resource] | None = None) -> DataFrame:
        """Raw SQL with ``?`` (or ``:name``) parameters; ``tables`` become views of that name for the statement."""
        with telemetry.span("tessera.query", query=sql), wrapped("raw SQL", sql, params):
            frames = {name: self.scan(r) for name, r in (tables or {}).items()}
            held = {t.name for t in self.spark.catalog.listTables() if t.isTemporary} if frames else set()
            before = {name: self.spark.table(identifiers.checked(name)) for name in frames if name in held}
            try:
                for name, frame in frames.items():
                    frame.createOrReplaceTempView(identifiers.checked(name))
                return self.spark.sql(sql, args=params if isinstance(params, dict) else list(params))
            finally:  # the statement has been resolved
                for name in frames:
                    self.spark.catalog.dropTempView(name)
                for name, frame in before.items():
                    frame.createOrReplaceTempView(name)

    def ping(self) -> bool:
        try:
            return self.spark.sql("SELECT 1").head()[0] == 1
        except Exception:
            return False

    def create_database(self, name: str | None = None) -> None:
        self.query(f"CREATE DATABASE IF NOT EXISTS {identifiers.quoted(identifiers.checked(name or self.database or 'default', 'database name'))}")

    def drop_database(self, name: str | None = None) -> None:
        self.query(f"DROP DATABASE IF EXISTS {identifiers.quoted(identifiers.checked(name or self.database or 'default', 'database name'))}")


class ParquetRepo(Repo):
    """``<root>/<table>.parquet`` for each resource; column pruning and filters reach the scan."""

    def __init__(self, spark: SparkSession, root: str, config: Config = DEFAULT):
        super().__init__(spark, config)
        self.root = root.rstrip("/")

    def scan(self, resource: Resource) -> DataFrame:
        with wrapped(f"scan of {resource.table_name}"):
            return self.spark.read.parquet(f"{self.root}/{resource.table_name}.parquet").select(*[identifiers.quoted(a.name) for a in resource.attributes])


class CatalogRepo(Repo):
    """Tables of the session's catalog."""

    def scan(self, resource: Resource) -> DataFrame:
        with wrapped(f"scan of {resource.table_name}"):
            return self.spark.table(identifiers.qualified(resource.table_name, resource.database or self.database)).select(*[identifiers.quoted(a.name) for a in resource.attributes])

    def exists(self, resource: Resource) -> bool:
        try:
            return self.spark.catalog.tableExists(identifiers.qualified(resource.table_name, resource.database or self.database))
        except Exception:
            return False


class FrameRepo(Repo):
    """Given frames by table name; for tests and for data that other jobs have prepared."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame], config: Config = DEFAULT):
        super().__init__(spark, config)
        self.frames = frames

    def scan(self, resource: Resource) -> DataFrame:
        if resource.table_name not in self.frames:
            raise QueryError(f"no table {resource.table_name!r}")
        return self.frames[resource.table_name].select(*[identifiers.quoted(a.name) for a in resource.attributes])
