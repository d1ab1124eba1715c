"""``python -m tessera setup|migrate|rollback|codegen MODULE``: tables and migrations of a module's resources."""

from __future__ import annotations

import argparse
import importlib
import logging
import time

from pyspark.sql import SparkSession

from tessera.plans import migrations as m
from tessera.sources.store import CatalogStore, StoreRepo


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    p.add_argument("command", choices=["setup", "migrate", "rollback", "codegen"])
    p.add_argument("module", help="a Python module that declares resources")
    p.add_argument("--database", default="default")
    p.add_argument("--migrations", default="migrations")
    p.add_argument("--snapshots", default="snapshots")
    p.add_argument("--ledger", default="ledger")
    p.add_argument("--to", default=None, help="version to roll back to (not included)")
    p.add_argument("--mode", default="write")
    p.add_argument("--dry-run", action="store_true")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    resources = m.find_resources(importlib.import_module(args.module))
    if args.command == "codegen":
        for s in m.generate(resources, args.snapshots, args.migrations, time.strftime("%Y%m%d%H%M%S", time.gmtime()), args.mode):
            print(s)
        return 0
    spark = spark or SparkSession.builder.getOrCreate()
    repo = CatalogStore(spark, database=args.database)
    if args.command == "setup":
        if not args.dry_run:
            repo.create_database()
        found = m.setup(repo, resources, args.dry_run)
        for name, what in found.items():
            print(name, what)
        return int(any(isinstance(x, str) for x in found.values()))
    runner = m.Runner(repo, StoreRepo(spark, args.ledger), m.discover(args.migrations))
    for version in runner.migrate(args.dry_run) if args.command == "migrate" else runner.rollback(args.to, args.dry_run):
        print(version)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
