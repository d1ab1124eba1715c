"""Helpers shared by the corpus operators: tables, shared storage, text buffers, components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch handed to Python, whatever the length of its texts.
BATCH_BYTES = 4 << 20
#: Bytes of texts that array passes take at a time (their temporary arrays hold some fifty bytes for each).
PIECE_BYTES = 1 << 19
#: Rows of a few numbers that may be broadcast (some 30 MB).
BROADCAST_ROWS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches are cut by bytes as well as rows, so long texts don't add up in a worker; what a user has set stays."""
    own = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES), "spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}
    held = spark.conf.getAll
    for name, value in own.items():
        if name not in held:
            spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the session names in ``spark.checkpoint.dir``."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share; intermediate tables go there")
    return found.rstrip("/")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder once and read it back, so lost executors cost a re-read only."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()  # Spark deletes the shuffle files of plans that nobody holds any more
    return spark.read.schema(df.schema).parquet(path)


def small_first(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """A written table of a few numbers a row, to be broadcast if it has at most ``BROADCAST_ROWS`` rows; else Spark sorts and merges.

    Where a row holds a list, ``weight`` tells how many rows it counts as.
    """
    rows = df.count() if weight is None else df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete what ``written`` wrote for ``df``; nothing may read it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if folder:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- text buffers


def pieces_of(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part's texts hold about ``most`` bytes (one text may hold more)."""
    n = batch.num_rows
    if not n:
        return
    array = batch.column(batch.schema.get_field_index(column))
    offsets = utf8(array)[1]
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        stop = min(stop, n)
        yield batch.slice(start, stop - start)
        start = stop


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without copying; null texts are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    n = len(array)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def code_points(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets in code points) of a string array; null texts are empty."""
    data, offsets = utf8(array)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
    return points, starts[offsets]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each (start, length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit values (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


# ---------------------------------------------------------------- connected components


def components(spark: SparkSession, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long) as rows (node long, component long = smallest node).

    Every round each node takes the smallest label among itself, its neighbours and its label's label
    (pointer jumping), so the rounds grow with the logarithm of the diameter. All rounds are joins and
    grouped minima with map-side combining; each is written to the shared folder, and only the count of
    changed labels reaches the driver. Nodes without an edge don't appear.
    """
    both = written(
        spark,
        edges.where("a is not null and b is not null and a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = written(spark, both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    for _ in range(most_rounds):
        told = both.join(labels, both.b == labels.node).select(both.a.alias("node"), "component")
        near = told.unionByName(labels).groupBy("node").agg(F.min("component").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        best = near.join(up, "component").select("node", F.least("component", "up").alias("component"))
        following = written(spark, best, "labels")
        changed = following.join(labels.withColumnRenamed("component", "was"), "node").where("component < was").limit(1).count()
        labels = following
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
