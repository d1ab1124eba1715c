"""Logical types: their Spark types, and lenient decoding of external text."""

from __future__ import annotations

import datetime as dt
import decimal
import logging
import re
import uuid
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

#: Logical names and the Spark type of each.
SCALARS: dict[str, T.DataType] = {
    "uuid": T.StringType(), "integer": T.LongType(), "float": T.DoubleType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "text": T.StringType(),
    "atom": T.StringType(), "ci_string": T.StringType(), "binary": T.BinaryType(), "utc_datetime": T.TimestampType(), "utc_datetime_usec": T.TimestampType(), "datetime": T.TimestampType(),
    "naive_datetime": T.TimestampNTZType(), "naive_datetime_usec": T.TimestampNTZType(), "date": T.DateType(), "time": T.StringType(), "time_usec": T.StringType(),
    "map": T.MapType(T.StringType(), T.StringType()), "list": T.ArrayType(T.StringType()), "array": T.ArrayType(T.StringType()),
}
PRECISION, SCALE = 38, 10


def spark_type(logical: Any, constraints: dict[str, Any] | None = None) -> T.DataType:
    """The Spark type of a logical type.

    ``logical``: a name, a Spark type, ``("array" | "set", t)``, ``("map", k, v)``, ``("tuple", [t, ...])``, or an
    object with ``storage_type()``, ``subtype_of()`` or ``type()``. What is unknown is stored as text, with a warning.
    """
    constraints = constraints or {}
    if isinstance(logical, T.DataType):
        return logical
    if logical == "decimal":
        return T.DecimalType(constraints.get("precision") or PRECISION, SCALE if constraints.get("scale") is None else constraints["scale"])
    if isinstance(logical, str) and logical in SCALARS:
        return SCALARS[logical]
    if isinstance(logical, tuple) and logical:
        match logical:
            case ("array" | "set", inner):
                return T.ArrayType(spark_type(inner))
            case ("map", key, value):
                return T.MapType(spark_type(key), spark_type(value))
            case ("tuple", inner):
                return T.StructType([T.StructField(f"_{i}", spark_type(t)) for i, t in enumerate(inner, 1)])
    for name in ("storage_type", "subtype_of", "type"):
        if callable(found := getattr(logical, name, None)):
            return spark_type(found(), constraints)
    log.warning("unknown type %r is stored as text", logical)
    return T.StringType()


def is_composite(logical: Any) -> bool:
    return isinstance(spark_type(logical), T.ArrayType | T.MapType | T.StructType)


def canonical_uuid(value: Any) -> Any:
    """A UUID, its 16 bytes or its text as 36 lower-case characters; anything else unchanged."""
    try:
        if isinstance(value, uuid.UUID):
            return str(value)
        if isinstance(value, bytes) and len(value) == 16:
            return str(uuid.UUID(bytes=value))
        return str(uuid.UUID(value)) if isinstance(value, str) else value
    except ValueError:
        return value


def uuid_bytes(value: str) -> bytes:
    return uuid.UUID(value).bytes


_NUMBER = re.compile(r"\s*([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)")


def decode(value: Any, logical: Any) -> Any:
    """A value from external text by its logical type; numbers may have trailing text, the rest passes unchanged."""
    if value is None:
        return None
    match logical:
        case "uuid":
            return canonical_uuid(value)
        case "integer" if isinstance(value, str):
            return int(m[0]) if (m := re.match(r"\s*[+-]?\d+", value)) else value
        case "float" | "double" if isinstance(value, str | int):
            return float(m[1]) if (m := _NUMBER.match(str(value))) else value
        case "decimal" if isinstance(value, str | int | float):
            return decimal.Decimal(m[1]) if (m := _NUMBER.match(str(value))) else value
        case "boolean":
            return {1: True, 0: False, "1": True, "0": False, "true": True, "false": False}.get(value, value)
        case "date" if isinstance(value, str):
            return _try(dt.date.fromisoformat, value)
        case "date" if isinstance(value, int):
            return dt.date(1970, 1, 1) + dt.timedelta(days=value)
        case "utc_datetime" | "utc_datetime_usec" | "datetime" if isinstance(value, str):
            found = _try(dt.datetime.fromisoformat, value)
            return found.replace(tzinfo=dt.UTC) if isinstance(found, dt.datetime) and found.tzinfo is None else found
        case "naive_datetime" | "naive_datetime_usec" if isinstance(value, str):
            found = _try(dt.datetime.fromisoformat, value)
            return found.replace(tzinfo=None) if isinstance(found, dt.datetime) else found
        case "list" | "array":
            return [None if x is None else str(x) for x in value] if isinstance(value, list | tuple) else value
        case "map":
            return {str(k): None if v is None else str(v) for k, v in value.items()} if isinstance(value, dict) else value
        case ("array" | "set", inner) if isinstance(value, list | tuple):
            return [decode(x, inner) for x in value]
        case ("map", key, inner) if isinstance(value, dict):
            return {decode(k, key): decode(v, inner) for k, v in value.items()}
        case ("tuple", inner) if isinstance(value, list | tuple):
            return tuple(decode(v, t) for v, t in zip(value, inner, strict=False))
        case "time" | "time_usec" if isinstance(value, dt.time):
            return value.isoformat()
        case "string" | "text" | "atom" | "ci_string" if not isinstance(value, str):
            return str(value)
    return value


def _try(parse, value):
    try:
        return parse(value)
    except ValueError:
        return value


def decode_column(column: Column, logical: Any) -> Column:
    """``decode`` for a text column, inside Spark; unparseable text becomes null."""
    head = F.regexp_extract(column, r"^\s*([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)", 1)
    match logical:
        case "integer":
            return F.regexp_extract(column, r"^\s*([+-]?\d+)", 1).try_cast("long")
        case "float" | "double":
            return head.try_cast("double")
        case "decimal":
            return head.try_cast(spark_type("decimal"))
        case "boolean":
            return F.when(column.isin("1", "true"), True).when(column.isin("0", "false"), False)
        case "uuid":
            return F.lower(column)
    return column.try_cast(spark_type(logical))
