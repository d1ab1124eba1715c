"""Names in SQL: quoting and validation."""

from __future__ import annotations

import re

from tessera.errors import ConfigurationError

_SAFE = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def valid(name: object) -> bool:
    return isinstance(name, str) and bool(_SAFE.fullmatch(name))


def checked(name: str, what: str = "identifier") -> str:
    """``name`` if it is a plain identifier, else ConfigurationError."""
    if not valid(name):
        raise ConfigurationError(f"invalid {what}: {name!r}")
    return name


def quoted(name: str) -> str:
    """Back-tick quoted, with back-ticks doubled."""
    return "`" + str(name).replace("`", "``") + "`"


def sanitized(name: str) -> str:
    """Only letters, digits and underscores are left."""
    return re.sub(r"[^A-Za-z0-9_]", "", name)


def qualified(table: str, database: str | None = None) -> str:
    parts = ([checked(database, "database name")] if database else []) + [checked(table, "table name")]
    return ".".join(quoted(p) for p in parts)
