"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned so that the axes of most energy come first (the eigenvectors of the
second moments of all vectors, added up by Spark). Linked vectors lie within ``sqrt(2 - 2 t)`` of each other
along every axis, so cells of that width on the first two axes need only meet their neighbours. Cells are cut
into tiles of bounded size, and each task compares two tiles: dot products grow by leading axes first, and
pairs whose dot product plus the product of the remaining (suffix) norms cannot reach ``t`` are dropped; what is
left at the end is decided by the cosine of the original vectors in double precision.

Equal vectors of one label are one class, and links are counted by class sizes, so copies are never expanded
into pairs. A tile task returns one row per linked vector: how many links it found, and the smallest vector
that it is connected with in there.

Defined cases: null labels, and vectors that are null, empty, zero or hold null or non-finite components, link
with nothing; vectors of different lengths don't link; rows with the same id are one node of the components,
each with its own count; a null id gets a null component; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, components, written
from tessera.llm.vectors import matrix, usable

#: Vectors in one tile, and the share of pairs alive below which they are followed one by one.
TILE, SPARSE = 1024, 0.05


def moments(vectors: DataFrame, dims: int) -> np.ndarray:
    """Sum of x x' over unit vectors; partial sums of each task meet in Spark, ``dims`` squared numbers come back in Arrow batches."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = matrix(batch.column(0), dims)
            x /= np.sqrt((x * x).sum(1, keepdims=True))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.reshape(-1))], ["at", "value"])

    sums = vectors.mapInArrow(partial, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(dims * dims)
    out[sums["at"].to_numpy()] = sums["value"].to_numpy()
    return out.reshape(dims, dims)


def linked_pairs(x: np.ndarray, y: np.ndarray, turn: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i in x, j in y) of pairs with cosine >= least; i < j where both are one tile."""
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    u, v = (x / nx[:, None]) @ turn, (y / ny[:, None]) @ turn
    dims, slack = x.shape[1], least - 1e-9
    left = lambda z: np.sqrt(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1])
    su, sv = left(u), left(v)
    steps = [s for s in (0, 8, 16, 32) if s < dims] + [dims]
    dots = np.zeros((len(x), len(y)))
    i = j = None
    for a, b in zip(steps, steps[1:], strict=False):
        if i is None:
            dots += u[:, a:b] @ v[:, a:b].T
            bound = dots if b == dims else dots + su[:, b : b + 1] * sv[:, b][None, :]
            alive = bound >= slack
            if same:
                alive = np.triu(alive, 1)
            if alive.mean() < SPARSE:
                i, j = np.nonzero(alive)
                dot = dots[i, j]
        else:
            dot = dot + (u[i, a:b] * v[j, a:b]).sum(1)
            keep = (dot if b == dims else dot + su[i, b] * sv[j, b]) >= slack
            i, j, dot = i[keep], j[keep], dot[keep]
    if i is None:
        i, j = np.nonzero(alive)
    found = [np.zeros(0, bool)]
    for a in range(0, len(i), 1 << 16):  # the final decision, on the vectors as given
        p, q = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
        found.append((x[p] * y[q]).sum(1) / (nx[p] * ny[q]) >= least)
    keep = np.concatenate(found)
    return i[keep], j[keep]


def near_duplicates(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """Rows (key, n_links, component_id, kept), one per row of ``vectors``."""
    bounded_batches(spark)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.col(label).alias("label"))
    rows = rows.withColumn("v", F.when(usable(F.col("v")) & F.col("label").isNotNull(), F.col("v")))
    sound = rows.where("v is not null").withColumn("dims", F.size("v"))
    classes = written(spark, sound.groupBy("label", "dims", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    lengths = [r["dims"] for r in classes.select("dims").distinct().collect()]  # as many rows as there are lengths
    turns = {}
    for dims in lengths:
        _, axes = np.linalg.eigh(moments(classes.where(F.col("dims") == dims).select("v"), dims))
        turns[dims] = np.ascontiguousarray(axes[:, ::-1])
    width = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(3).to_numpy()
            cells = np.zeros((batch.num_rows, 2), np.int32)
            for dims in np.unique(size):
                at = np.flatnonzero(size == dims)
                x = matrix(batch.column(4).take(pa.array(at)), int(dims))
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                first = np.floor((x @ turns[int(dims)])[:, :2] / width).astype(np.int32)
                cells[at, : first.shape[1]] = first
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[:, 0]), pa.array(cells[:, 1])], [*batch.schema.names, "c1", "c2"])

    kind = vectors.schema[label].dataType.simpleString()
    inner = vectors.schema[vector].dataType.simpleString()
    cells = classes.select("rep", "copies", "label", "dims", "v").mapInArrow(placed, f"rep long, copies long, label {kind}, dims int, v {inner}, c1 int, c2 int")
    place = ["label", "dims", "c1", "c2"]
    tiles = cells.groupBy(place).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    own = cells.join(tiles, place).withColumn("tile", F.pmod(F.xxhash64("rep", "v"), F.col("tiles").cast("long")).cast("int"))
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])).alias("step")
    others = tiles.select("label", "dims", F.col("c1").alias("n1"), F.col("c2").alias("n2"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    sent = own.select("*", near).withColumns({"n1": F.col("c1") + F.col("step.a"), "n2": F.col("c2") + F.col("step.b")}).join(others, ["label", "dims", "n1", "n2"])
    here, there = F.struct("c1", "c2", F.col("tile").alias("t")), F.struct(F.col("n1").alias("c1"), F.col("n2").alias("c2"), F.col("other").alias("t"))
    sent = sent.select("label", "dims", F.least(here, there).alias("low"), F.greatest(here, there).alias("high"), (here <= there).alias("is_low"), "rep", "copies", "v")

    def compared(group: pa.Table) -> pa.Table:
        dims = group["dims"][0].as_py()
        lows = group["is_low"].to_numpy()
        same = group["low"][0] == group["high"][0]
        x, rep, copies = matrix(group["v"], dims), group["rep"].to_numpy(), group["copies"].to_numpy()
        p = np.flatnonzero(lows)
        q = p if same else np.flatnonzero(~lows)
        i, j = linked_pairs(x[p], x[q], turns[dims], least, same) if len(p) and len(q) else (np.zeros(0, np.int64),) * 2
        i, j = p[i], q[j]
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = rep.copy()
        while True:
            low = np.minimum(root[i], root[j])
            after = root.copy()
            np.minimum.at(after, i, low)
            np.minimum.at(after, j, low)
            if (after == root).all():
                break
            root = after
        hit = np.unique(np.concatenate([i, j]))
        return pa.table({"label": group["label"].take(pa.array(hit)), "v": group["v"].take(pa.array(hit)), "rep": rep[hit], "links": links[hit], "root": root[hit]})

    found = written(spark, sent.groupBy("label", "dims", "low", "high").applyInArrow(compared, f"label {kind}, v {inner}, rep long, links long, root long"), "tiles")
    links = found.groupBy("label", "v").agg(F.sum("links").alias("links"))
    # ids shared by several vectors tie their classes together
    tied = sound.join(classes.select("label", "v", "rep"), ["label", "v"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    labels = components(spark, found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(tied))
    named = classes.select("label", "v", "copies").join(links, ["label", "v"], "left")
    out = rows.join(named, ["label", "v"], "left").join(labels.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
reach(node, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.seen = links.a),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON node = e.vec_id LEFT JOIN counts ON a = e.vec_id
"""
