"""Table definitions as Spark SQL: create, evolve by adding, and reverse."""

from __future__ import annotations

import datetime as dt
import decimal
import logging
import re
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tessera import identifiers
from tessera.config import DEFAULT, Config
from tessera.errors import ConfigurationError
from tessera.schema import Attribute, Index, Resource

log = logging.getLogger(__name__)

_MONTH = re.compile(r"toYYYYMM\((\w+)\)")


def literal(value: Any) -> str:
    """A static default as a SQL literal."""
    match value:
        case bool():
            return "TRUE" if value else "FALSE"
        case int() | decimal.Decimal():
            return str(value)
        case float():
            return f"{value!r}D"
        case dt.datetime():
            stamp = value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
            return f"TIMESTAMP '{stamp.isoformat(sep=' ')}'"
        case dt.date():
            return f"DATE '{value.isoformat()}'"
        case str():
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise ConfigurationError(f"no literal for a default of {type(value).__name__}")


def column(a: Attribute) -> str:
    """``name TYPE [NOT NULL] [DEFAULT literal]``; defaults that are functions are left to inserts."""
    f = a.field()
    default = "" if a.default is None or callable(a.default) else f" DEFAULT {literal(a.default)}"
    return f"{identifiers.quoted(a.name)} {f.dataType.simpleString().upper() if not isinstance(f.dataType, T.StructType) else f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}{default}"


def partition(resource: Resource) -> tuple[str, str] | None:
    """(derived column, expression) of a partition: a column's name, or its month as ``toYYYYMM(column)``."""
    if not resource.partition_by:
        return None
    if found := _MONTH.fullmatch(resource.partition_by):
        return f"p_{found[1]}_yyyymm", f"date_format({identifiers.quoted(found[1])}, 'yyyyMM')"
    if resource.partition_by in resource.by_name:
        return resource.partition_by, identifiers.quoted(resource.partition_by)
    raise ConfigurationError(f"{resource.name}: no partition by {resource.partition_by!r}")


def _property(key: str, value: Any) -> str:
    return f"{literal(key)} = {literal(str(value))}"


def index_properties(resource: Resource) -> dict[str, str]:
    """Indexes as table properties; bloom filters also as the Parquet option that makes them."""
    out = {}
    for i in resource.indexes:
        out[f"tessera.index.{i.name}"] = f"{i.expression} TYPE {i.type} GRANULARITY {i.granularity}"
        if i.type.startswith("bloom_filter") and i.expression in resource.by_name:
            out[f"parquet.bloom.filter.enabled#{i.expression}"] = "true"
    return out


def create_table(resource: Resource, config: Config = DEFAULT, database: str | None = None) -> str:
    if config.strict_nullability:
        resource.check_nullability()
    columns = [column(a) for a in resource.attributes]
    parted = partition(resource)
    if parted and parted[0] not in resource.by_name:
        columns.append(f"{identifiers.quoted(parted[0])} STRING")
    properties = {"tessera.engine": resource.engine, "tessera.order_by": ",".join(resource.layout_keys) or "tuple()", "tessera.primary_key": ",".join(resource.primary_key or resource.keys)}
    if resource.settings:
        properties["tessera.settings"] = resource.settings
    properties |= index_properties(resource)
    return (
        f"CREATE TABLE IF NOT EXISTS {identifiers.qualified(resource.table_name, resource.database or database)} ({', '.join(columns)}) USING parquet"
        + (f" PARTITIONED BY ({identifiers.quoted(parted[0])})" if parted else "")
        + (f" COMMENT {literal(resource.description)}" if resource.description else "")
        + f" TBLPROPERTIES ({', '.join(_property(k, v) for k, v in properties.items())})"
    )


def table_exists(spark: SparkSession, resource: Resource, database: str | None = None) -> bool:
    try:
        return spark.catalog.tableExists(identifiers.qualified(resource.table_name, resource.database or database))
    except Exception:
        return False


def _held(spark: SparkSession, resource: Resource, database: str | None) -> tuple[set[str], dict[str, str]]:
    """(columns, properties) of the table in the catalog."""
    name = identifiers.qualified(resource.table_name, resource.database or database)
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return set(spark.table(name).columns), properties


def add_columns(resource: Resource, held: set[str], database: str | None = None) -> list[str]:
    """One statement per attribute that the table lacks."""
    name = identifiers.qualified(resource.table_name, resource.database or database)
    return [f"ALTER TABLE {name} ADD COLUMNS ({identifiers.quoted(a.name)} {a.field().dataType.simpleString()})" for a in resource.attributes if a.name not in held]


def add_indexes(resource: Resource, properties: dict[str, str], database: str | None = None) -> tuple[list[str], list[str]]:
    """(statements for indexes that the table lacks, warnings about indexes that differ from their declaration)."""
    name = identifiers.qualified(resource.table_name, resource.database or database)
    statements, warnings = [], []
    for index in resource.indexes:
        key, text = f"tessera.index.{index.name}", index_text(index)
        if key not in properties:
            statements.append(f"ALTER TABLE {name} SET TBLPROPERTIES ({_property(key, text)})")
        elif properties[key] != text:
            warnings.append(f"index {index.name} of {resource.table_name} is {properties[key]!r}, declared {text!r}; to change it: ALTER TABLE {name} UNSET TBLPROPERTIES ({literal(key)}); ALTER TABLE {name} SET TBLPROPERTIES ({_property(key, text)})")
    return statements, warnings


def index_text(index: Index) -> str:
    return f"{index.expression} TYPE {index.type} GRANULARITY {index.granularity}"


def pending(spark: SparkSession, resource: Resource, config: Config = DEFAULT, database: str | None = None) -> list[str]:
    """What brings the catalog to the declaration: a new table, or added columns and indexes. Nothing is dropped."""
    if not table_exists(spark, resource, database):
        return [create_table(resource, config, database)]
    held, properties = _held(spark, resource, database)
    statements, warnings = add_indexes(resource, properties, database)
    for w in warnings:
        log.warning(w)
    return add_columns(resource, held, database) + statements


_CREATE = re.compile(r"\s*CREATE TABLE (?:IF NOT EXISTS )?(\S+)", re.I)
_INDEX = re.compile(r"\s*ALTER TABLE (\S+) SET TBLPROPERTIES \(('tessera\.index\.[^']+')", re.I)


def reverse(statement: str) -> str | None:
    """The statement that takes it back, or None where there is none: Spark's file tables can't drop a column."""
    if m := _CREATE.match(statement):
        return f"DROP TABLE IF EXISTS {m[1]}"
    if m := _INDEX.match(statement):
        return f"ALTER TABLE {m[1]} UNSET TBLPROPERTIES IF EXISTS ({m[2]})"
    return None
