"""Versioned, reversible migrations with a ledger, and their generation from snapshots of resources."""

from __future__ import annotations

import importlib.util
import json
import logging
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from tessera.config import DEFAULT, Config
from tessera.errors import ConfigurationError, QueryError
from tessera.plans import ddl
from tessera.schema import Attribute, Resource
from tessera.sources.repo import Repo
from tessera.sources.store import StoreRepo

log = logging.getLogger(__name__)

LEDGER = Resource("schema_migrations", (Attribute("version", "string", primary_key=True), Attribute("inserted_at", "utc_datetime")))


@dataclass(frozen=True)
class Migration:
    """``change`` gives the statements; ``down`` those that take them back, else they are derived where possible."""

    version: str
    change: Callable[[], Iterable[str]]
    down: Callable[[], Iterable[str]] | None = None
    name: str = ""

    def reversal(self) -> list[str] | None:
        if self.down is not None:
            return list(self.down())
        found = [ddl.reverse(s) for s in reversed(list(self.change()))]
        return None if None in found else found


def version_of(path: Path, module: Any = None) -> str:
    """The module's ``version``, else the file name's first 14 digits, else the file name."""
    declared = getattr(module, "version", None)
    if declared is not None:
        return str(declared() if callable(declared) else declared)
    found = re.match(r"\d{14}", path.stem)
    return found[0] if found else path.stem


def discover(folder: str | Path) -> list[Migration]:
    """The migrations in a folder of Python files with ``change()`` and maybe ``down()`` and ``version``."""
    out = []
    for path in sorted(Path(folder).glob("*.py")):
        spec = importlib.util.spec_from_file_location(f"migration_{path.stem}", path)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        if not callable(getattr(module, "change", None)):
            raise ConfigurationError(f"{path.name} has no change()")
        out.append(Migration(version_of(path, module), module.change, getattr(module, "down", None), path.stem))
    return out


def _order(version: str) -> tuple:
    return (0, int(version), version) if version.isdigit() else (1, 0, version)


def _after(version: str, target: str) -> bool:
    """Numbers compare as numbers when both are, else as text."""
    return int(version) > int(target) if version.isdigit() and target.isdigit() else version > target


@dataclass
class Runner:
    """Applies migrations to ``repo`` and keeps the applied versions in ``ledger``."""

    repo: Repo
    ledger: StoreRepo
    migrations: list[Migration] = field(default_factory=list)

    def __post_init__(self):
        versions = [m.version for m in self.migrations]
        if len(set(versions)) < len(versions):
            raise ConfigurationError("migration versions repeat")

    def applied(self) -> list[str]:
        self.ledger.create(LEDGER)
        return sorted((r["version"] for r in self.ledger.scan(LEDGER).select("version").distinct().collect()), key=_order)

    def pending(self) -> list[Migration]:
        done = set(self.applied())
        return [m for m in sorted(self.migrations, key=lambda m: _order(m.version)) if m.version not in done]

    def migrate(self, dry_run: bool = False) -> list[str]:
        """Apply what is pending in order of version, up to the first failure; returns the versions."""
        import datetime as dt

        out = []
        for m in self.pending():
            for statement in m.change():
                log.info("%s: %s", m.version, statement)
                if not dry_run:
                    self.repo.query(statement)
            if not dry_run:
                self.ledger.insert(LEDGER, {"version": m.version, "inserted_at": dt.datetime.now(dt.UTC)})
            out.append(m.version)
        return out

    def rollback(self, target: Any = None, dry_run: bool = False) -> list[str]:
        """Take back what lies after ``target``, newest first; None, 0, "0" and "all" mean everything.

        Migrations that can't be taken back are left applied, with a warning.
        """
        if target in (None, 0, "0", "all"):
            target = None
        elif isinstance(target, bool) or not isinstance(target, int | str):
            raise QueryError(f"not a version to roll back to: {target!r}")
        known, out = {m.version: m for m in self.migrations}, []
        for version in sorted(self.applied(), key=_order, reverse=True):
            if target is not None and not _after(version, str(target)):
                continue
            statements = known[version].reversal() if version in known else None
            if statements is None:
                log.warning("migration %s can't be taken back", version)
                continue
            for statement in statements if not dry_run else ():
                self.repo.query(statement)
            if not dry_run:
                self.ledger.delete_where(LEDGER, ("version", "eq", version))
            out.append(version)
        return out


# ---- generation


def snapshot(resource: Resource) -> dict[str, Any]:
    """What of a resource matters to its table."""
    return {
        "table": resource.table_name, "database": resource.database, "engine": resource.engine, "order_by": list(resource.layout_keys), "partition_by": resource.partition_by,
        "schema": resource.schema().jsonValue(), "indexes": {i.name: ddl.index_text(i) for i in resource.indexes},
    }


def difference(resource: Resource, before: dict[str, Any] | None, config: Config = DEFAULT) -> list[str]:
    """The statements from a snapshot to the resource as declared."""
    if before is None:
        return [ddl.create_table(resource, config)]
    statements, warnings = ddl.add_indexes(resource, {f"tessera.index.{k}": v for k, v in before["indexes"].items()})
    for w in warnings:
        log.warning(w)
    return ddl.add_columns(resource, {f["name"] for f in before["schema"]["fields"]}) + statements


def generate(resources: Iterable[Resource], snapshots: str | Path, folder: str | Path, version: str, mode: str = "write", config: Config = DEFAULT) -> list[str]:
    """Write a migration for what changed since the snapshots, and the new snapshots.

    ``mode``: write; ``check`` raises where something changed; ``dry_run`` only returns the statements; ``dev``
    writes a migration whose name is marked so.
    """
    if mode not in ("write", "check", "dry_run", "dev"):
        raise ConfigurationError(f"unknown mode {mode!r}")
    snapshots, folder = Path(snapshots), Path(folder)
    statements, new = [], {}
    for r in resources:
        if not r.migrate:
            continue
        path = snapshots / f"{'.'.join(filter(None, (r.database, r.table_name)))}.json"
        statements += difference(r, json.loads(path.read_text()) if path.exists() else None, config)
        new[path] = json.dumps(snapshot(r), indent=1, sort_keys=True)
    if mode == "check" and statements:
        raise ConfigurationError(f"{len(statements)} statements have no migration: {statements[0]}")
    if mode in ("write", "dev") and statements:
        folder.mkdir(parents=True, exist_ok=True)
        snapshots.mkdir(parents=True, exist_ok=True)
        back = [ddl.reverse(s) for s in reversed(statements)]
        text = f'"""Generated migration."""\n\n\ndef change():\n    return {statements!r}\n\n\ndef down():\n    return {[b for b in back if b]!r}\n'
        (folder / f"{version}_{'dev' if mode == 'dev' else 'generated'}.py").write_text(text)
        for path, content in new.items():
            path.write_text(content)
    return statements


# ---- release


def setup(repo: Repo, resources: Iterable[Resource], dry_run: bool = False) -> dict[str, list[str] | str]:
    """Bring every resource's table up to date; one that fails doesn't keep the others from it."""
    out: dict[str, list[str] | str] = {}
    for r in resources:
        if not r.migrate:
            continue
        try:
            statements = ddl.pending(repo.spark, r, repo.config, repo.database)
            for s in statements if not dry_run else ():
                repo.query(s)
            out[r.name] = statements
        except Exception as e:
            log.error("%s: %s", r.name, e)
            out[r.name] = f"error: {e}"
    return out


def find_resources(module: Any) -> list[Resource]:
    """The resources that a module declares."""
    return [x for x in vars(module).values() if isinstance(x, Resource)]
