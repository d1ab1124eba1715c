"""Approximate nearest neighbours with a permutation index.

A bounded number of rows serve as pivots. Every vector is represented by its ``prefix`` nearest pivots in order
of nearness; a block of vectors is posted in one inverted file per pivot, which lists the vectors that have that
pivot in their prefix and where. A query walks the files of its own prefix and adds up, vector by vector, what
each shared pivot takes off the footrule distance (the sum of place differences, with absent pivots at the
end). The pivots' own distances and cosines tell what cosine a distance stands for, and how far off that may be;
so a vector's rank is its distance, read as a cosine, times its norm, as the measure is the inner product.

The first ``share`` of a block by that rank, ties to the smaller id, are reranked by the exact inner product in
double precision. Then all others follow whose inner product, at ``DOUBT`` deviations above what their distance
stands for, would still reach the ``k``-th best found: few for most queries, a whole crowd of near copies where the
query lies in one. The best of all blocks make the result.

Spark sends each block of queries to each block of the index, so no task holds more than two blocks, and no row
is left out of the index.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, as query or
candidate; only vectors of a query's own length are its candidates; a null id takes no part; of rows with the
same id each is a candidate, and none of a query's own id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, written
from tessera.llm.vectors import matrix, usable

#: Pivots at most, their places that count, vectors of an index block, queries of a query block.
PIVOTS, PREFIX, BLOCK, QUERIES = 256, 64, 16384, 2048
#: The share of a block, and the least number, that is reranked first; deviations of doubt for the others.
SHARE, LEAST, DOUBT = 1 / 32, 256, 3.0
#: With fewer pivots distances tell nothing, and all of a block is reranked.
FEW = 16


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each row's ``prefix`` nearest pivots, nearest first."""
    near = -(x @ (pivots / np.sqrt((pivots * pivots).sum(1, keepdims=True))).T)
    prefix = min(prefix, near.shape[1])
    some = np.argpartition(near, prefix - 1, axis=1)[:, :prefix]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(near, some, 1), axis=1, kind="stable"), 1)


class InvertedFiles:
    """Per pivot: which rows have it in their prefix, and at what place."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        self.n, self.prefix = order.shape
        flat = order.reshape(-1)
        by = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[by], np.arange(n_pivots + 1))
        self.rows = [by[a:b] // self.prefix for a, b in zip(ends, ends[1:], strict=False)]
        self.places = [(by[a:b] % self.prefix).astype(np.int32) for a, b in zip(ends, ends[1:], strict=False)]

    def shared(self, order: np.ndarray) -> np.ndarray:
        """What the pivots of a prefix take off each row's footrule distance from it."""
        shared = np.zeros(self.n, np.int64)
        for place, pivot in enumerate(order):
            shared[self.rows[pivot]] += self.prefix - np.maximum(self.places[pivot], place)
        return shared

    def nearest(self, order: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` rows of least footrule distance from a prefix, ties to the earlier row."""
        return foremost(self.shared(order), most)


def foremost(value: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` rows of largest value, ties to the earlier row."""
    if most >= len(value):
        return np.arange(len(value))
    least = np.partition(value, len(value) - most)[len(value) - most]
    above = np.flatnonzero(value > least)
    return np.concatenate([above, np.flatnonzero(value == least)[: most - len(above)]])


def cosine_of_shared(pivots: np.ndarray, prefix: int) -> tuple[float, float, float]:
    """(at 0, slope, deviation) of the line that gives two vectors' cosine by what their prefixes share, as the pivots
    show it; without enough pivots, or where all share the same, the deviation is infinite."""
    if len(pivots) < FEW:
        return 0.0, 0.0, np.inf
    order = permutations(pivots, pivots, prefix)
    files = InvertedFiles(order, len(pivots))
    shared = np.array([files.shared(o) for o in order], np.float64)
    unit = pivots / np.sqrt((pivots * pivots).sum(1, keepdims=True))
    apart = ~np.eye(len(pivots), dtype=bool)
    x, y = shared[apart], (unit @ unit.T)[apart]
    if x.std() == 0:
        return 0.0, 0.0, np.inf
    slope = ((x - x.mean()) * (y - y.mean())).mean() / x.var()
    start = y.mean() - slope * x.mean()
    return float(start), float(slope), float((y - start - slope * x).std())


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX) -> DataFrame:
    """Rows (query_id, rank, key, score): each query's ``k`` nearest found."""
    bounded_batches(spark)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("asks")).where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dims", F.size("v"))
    chosen = rows.select("dims", "v").distinct().withColumn("place", F.row_number().over(Window.partitionBy("dims", F.pmod(F.xxhash64("v"), F.lit(64))).orderBy(F.xxhash64(F.lit(1), "v"), "v")))
    chosen = chosen.where(F.col("place") <= pivots).groupBy("dims").agg(F.slice(F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(1), "v").alias("h"), "v"))), 1, pivots).alias("found"))
    axes = {r["dims"]: np.array([x["v"] for x in r["found"]], np.float64) for r in chosen.collect()}  # ``pivots`` rows a length

    counts = rows.groupBy("dims").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK)).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.sum(F.col("asks").cast("int")) / QUERIES)).cast("int").alias("asked"))
    placed = rows.join(F.broadcast(counts), "dims")  # one row a vector length
    index = placed.select("dims", "id", "v", F.lit(False).alias("asks"), F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("asked") - 1)).alias("asked"))
    queries = placed.where("asks").select("dims", "id", "v", "asks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("id", F.lit(5)), F.col("asked")).cast("int").alias("asked"))

    def searched(group: pa.Table) -> pa.Table:
        dims = group["dims"][0].as_py()
        group = group.sort_by("id")
        asks, ids, x = group["asks"].to_numpy(), group["id"].to_numpy(), matrix(group["v"], dims)
        q, c = np.flatnonzero(asks), np.flatnonzero(~asks)
        out: list[tuple[np.ndarray, ...]] = []
        if len(q) and len(c):
            data, pivot = np.ascontiguousarray(x[c]), axes[dims]
            files = InvertedFiles(permutations(data, pivot, prefix), len(pivot))
            start, slope, deviation = cosine_of_shared(pivot, prefix)
            norm = np.sqrt((data * data).sum(1))
            most = max(LEAST, int(np.ceil(SHARE * len(c)))) if np.isfinite(deviation) else len(c)
            for i, order in zip(q, permutations(x[q], pivot, prefix), strict=True):
                cosine = start + slope * files.shared(order) if most < len(c) else np.zeros(len(c))
                near = foremost(cosine * norm, most)
                score = data[near] @ x[i]
                known = score[ids[c[near]] != ids[i]]
                if most < len(c):
                    least = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else -np.inf
                    hopeful = (cosine + DOUBT * deviation) * norm * np.sqrt(x[i] @ x[i]) >= least
                    hopeful[near] = False
                    more = np.flatnonzero(hopeful)
                    near, score = np.concatenate([near, more]), np.concatenate([score, data[more] @ x[i]])
                others = ids[c[near]] != ids[i]
                near, score = near[others], score[others]
                if len(near) > k:
                    cut = np.partition(score, len(score) - k)[len(score) - k]
                    cut -= 1e-9 * max(1.0, abs(cut))
                    near, score = near[score >= cut], score[score >= cut]
                score = (data[near] * x[i]).sum(1)
                best = np.lexsort((ids[c[near]], -score))[:k]
                out.append((np.full(len(best), ids[i]), ids[c[near[best]]], score[best]))
        a, b, s = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": a, "id": b, "score": s})

    found = index.unionByName(queries).groupBy("dims", "block", "asked").applyInArrow(searched, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = written(spark, found, "found").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
