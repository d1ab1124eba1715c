"""Rows from a place of an order on, without a task that sees them all.

The place is found as the row that stands there: a sample of the rows around it gives splits, one aggregate counts
the rows before each, and the rows between two splits are looked at again until few are left. What remains is a
filter. Only splits (some tens) and samples (some thousand rows of the sort keys) reach the driver.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of the sort keys that are fetched or sampled at a time.
FEW = 2000
#: Places of a sorted sample, from the expected one, that become splits.
_AROUND = (-400, -100, -30, -10, 0, 10, 30, 100, 400)


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind)
    return not isinstance(kind, T.MapType | T.VariantType)


def _before(left: list[Column], right: list[Column], orders: list[str]) -> Column:
    """Whether keys ``left`` stand strictly before ``right``; all are given from the first key on."""
    out = F.lit(False)
    for a, b, order in reversed(list(zip(left, right, orders, strict=True))):
        less = a > b if order.startswith("desc") else a < b
        nil = a.isNull() & b.isNotNull() if order.endswith("nils_first") else a.isNotNull() & b.isNull()
        out = F.coalesce(less, F.lit(False)) | nil | (a.eqNullSafe(b) & out)
    return out


class _Place:
    """The row at place ``n`` of ``rows`` by ``sorts``: ``row`` (one, or none if there are not so many), the rows
    before it and those that are equal to it by the keys."""

    def __init__(self, rows: DataFrame, sorts: list[tuple[str, str]], n: int, ordering: dict):
        self.spark, self.orders, self.n = rows.sparkSession, [o for _, o in sorts], n
        self.keys = [f"key_{i}" for i in range(len(sorts))]
        self.rows = rows.select(*[F.col(f"`{name}`").alias(k) for (name, _), k in zip(sorts, self.keys, strict=True)])
        self.order = [ordering[o](F.col(k)) for k, o in zip(self.keys, self.orders, strict=True)]
        self.row: pa.Table | None = None
        self.before = self.equal = 0
        self._find()

    def frame(self, splits: pa.Table) -> DataFrame:
        """The splits to compare with, as columns ``at_``."""
        made = self.spark.createDataFrame(splits.select(self.keys), self.rows.schema)
        return F.broadcast(made.select(*[F.col(k).alias(f"at_{k}") for k in self.keys]))

    def compared(self, columns: list[Column]) -> tuple[Column, Column]:
        """Whether a row stands before, and whether after, the split beside it."""
        at = [F.col(f"at_{k}") for k in self.keys]
        return _before(columns, at, self.orders), _before(at, columns, self.orders)

    def counted(self, splits: pa.Table) -> list[tuple[int, int, int]]:
        """(rows before, rows before or equal, number) of each split."""
        numbered = splits.append_column("split_", pa.array(range(len(splits)), pa.int32()))
        schema = T.StructType([*self.rows.schema.fields, T.StructField("split_", T.IntegerType())])
        at = self.spark.createDataFrame(numbered, schema).select(*[F.col(k).alias(f"at_{k}") for k in self.keys], "split_")
        before, after = self.compared([F.col(k) for k in self.keys])
        sums = self.rows.crossJoin(F.broadcast(at)).groupBy("split_").agg(F.sum(before.cast("long")), F.sum((~after).cast("long")))
        return sorted((b, e, s) for s, b, e in sums.collect())

    def _find(self) -> None:
        region, first, last = self.rows, 0, self.rows.count()
        while self.n < last and self.row is None:
            if last - first <= FEW:
                held = region.orderBy(*self.order).limit(self.n - first + 1).toArrow()
                splits = held.slice(len(held) - 1)
            else:
                held = region.sample(FEW / (last - first)).orderBy(*self.order).toArrow()
                middle = len(held) * (self.n - first) // (last - first)
                splits = held.take(pa.array(sorted({min(max(middle + d, 0), len(held) - 1) for d in _AROUND} if len(held) else [])))
            lower = upper = None
            for before, upto, k in self.counted(splits) if len(splits) else ():
                if before <= self.n < upto:
                    self.row, self.before, self.equal = splits.slice(k, 1), before, upto - before
                elif upto <= self.n and upto >= first:
                    first, lower = upto, k
                elif before > self.n and before <= last and upper is None:
                    last, upper = before, k
            for k, side in ((lower, 1), (upper, 0)):
                if k is not None and self.row is None:
                    condition = self.compared([F.col(k) for k in self.keys])[side]
                    region = region.join(self.frame(splits.slice(k, 1)), condition, "left_semi")


def skip(rows: DataFrame, sorts: list[tuple[str, str]], n: int, ordering: dict) -> DataFrame:
    """``rows`` without the first ``n`` by ``sorts``, in no order; ties are broken by the other columns."""
    place = _Place(rows, sorts, n, ordering)
    if place.row is None:
        return rows.limit(0)
    names = [name for name, _ in sorts]
    before, after = place.compared([F.col(f"`{name}`") for name in names])
    at = place.frame(place.row)
    dropped = n - place.before
    if not dropped:
        return rows.join(at, ~before, "left_semi")
    kept, equal = rows.join(at, after, "left_semi"), rows.join(at, ~before & ~after, "left_semi")
    others = [(f.name, "asc") for f in rows.schema if f.name not in names]
    if any(not _ordered(rows.schema[name].dataType) for name, _ in others):
        return kept.unionByName(equal.offset(dropped))
    if others:
        return kept.unionByName(skip(equal, [*sorts, *others], dropped, ordering))
    # the rows are copies of one
    one = place.spark.createDataFrame(place.row, place.rows.schema)
    copies = place.spark.range(place.equal - dropped).crossJoin(F.broadcast(one))
    return kept.unionByName(copies.select(*[F.col(k).alias(name) for k, name in zip(place.keys, names, strict=True)]))
