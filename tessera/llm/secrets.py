"""Secret scans with corpus-wide ownership frequency.

One pass over the whole texts finds candidate spans: three base kinds (assignments, access keys, long hex
runs) and some further credential formats. Each candidate's value is hashed; Spark then counts, over the
whole corpus, by how many distinct repositories (documents) and owners (sources) each hash is held. A value
that many owners hold is a widely copied example; one that few hold is owner-specific and live-looking.
Base spans always stay; further spans are added only where they look live.

Defined cases: null and empty texts hold nothing; a document's repeated value counts once for that document;
repeated rows are scanned and returned each for itself (counted once a row and owner); a null repository or
owner counts as one of its own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bounded_batches, pieces_of, small_first, utf8, written

#: The base kinds and how long a match (of assign: its value) must be.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: What the method adds: kind, a substring that such a text must hold, its pattern (group 1: the value).
ADDED = (
    ("bearer", "earer ", re.compile(r"\b[Bb]earer ([A-Za-z0-9._~+/-]{20,}=*)")),
    ("github", "gh", re.compile(r"\b(gh[pousr]_[A-Za-z0-9]{36,})")),
    ("slack", "xox", re.compile(r"\b(xox[abprs]-[A-Za-z0-9-]{10,})")),
    ("jwt", "eyJ", re.compile(r"\b(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*)")),
    ("pem", "PRIVATE KEY", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----\s*([A-Za-z0-9+/=\s]{16,})")),
    ("url", "://", re.compile(r"[a-z][a-z0-9+.-]*://[^\s/:@]+:([^\s/@]{6,})@")),
)
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *(k for k, _, _ in ADDED))
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_SPAN = "struct<start:int,end:int,kind:int,value:bigint>"


def find_spans(text: str, maybe_hex: bool = True) -> list[tuple[int, int, int, str]]:
    """(start, end, kind's place in KINDS, value) of every candidate, by start and kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(*m.span(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), 1, m[0]) for m in ACCESS.finditer(text)]
    if maybe_hex:
        found += [(*m.span(), 2, m[0]) for m in HEX.finditer(text)]
    for k, (_, hint, pattern) in enumerate(ADDED, len(BASE)):
        if hint in text:
            found += [(*m.span(), k, m[1]) for m in pattern.finditer(text)]
    return sorted(found)


def long_hex(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: may it hold 24 hex digits in a row? (May also be so across two texts' border.)"""
    table = np.zeros(256, bool)
    table[list(b"0123456789abcdef")] = True
    run = table[data]
    for step in (1, 2, 4, 8):
        run = run[:-step] & run[step:] if len(run) > step else run[:0]
    run = run[:-8] & run[8:] if len(run) > 8 else run[:0]  # 16 from here and 16 from 8 on
    at = np.flatnonzero(run)
    may = np.zeros(len(offsets) - 1, bool)
    if len(at):
        may[np.unique(np.clip(np.searchsorted(offsets, at, "right") - 1, 0, len(may) - 1))] = True
    return may


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def scan(docs: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (key, keep..., spans): the candidates of every text, in the order of the input."""
    columns = list(dict.fromkeys((key, *keep)))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "text_"):
                array = batch.column(batch.schema.get_field_index("text_"))
                may = long_hex(*utf8(array))
                rows = []
                for t, h in zip(array.to_pylist(), may, strict=True):
                    rows.append([{"start": a, "end": b, "kind": k, "value": _hash(v)} for a, b, k, v in find_spans(t, h)] if t else [])
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), pa.array(rows, kind)], [*columns, "spans"])

    bounded_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[c] for c in columns])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema]).add("spans", T._parse_datatype_string(f"array<{_SPAN}>"))
    return docs.select(*columns, F.col(text).alias("text_")).mapInArrow(found, schema)


def ownership(spans: DataFrame, repo: str, owner: str) -> DataFrame:
    """Rows (value, n_repos, n_owners) over all candidates.

    Each (value, repository, owner) is reduced on the map side, then each (value, owner), so a value that
    a third of all rows hold is added up from as many partial rows as there are owners and tasks.
    """
    each = spans.select(F.explode(F.array_distinct(F.transform("spans", lambda s: s["value"]))).alias("value"), F.col(repo).alias("repo"), F.col(owner).alias("owner"))
    by_owner = each.groupBy("value", "owner", F.pmod(F.xxhash64("repo"), F.lit(16)).alias("salt")).agg(F.count_distinct("repo").alias("repos"), F.max(F.col("repo").isNull().cast("int")).alias("none"))
    by_owner = by_owner.groupBy("value", "owner").agg(F.sum(F.col("repos") + F.col("none")).alias("repos"))
    return by_owner.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def find_secrets(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", example_owners: int = 3, example_repos: int = 5) -> DataFrame:
    """Rows (key, row, spans array<struct<start, end, kind, value, live>>), one per document.

    ``row`` tells repeated keys apart. A value held by at least ``example_owners`` owners and
    ``example_repos`` documents is a widely copied example, any other is live-looking.
    """
    spans = written(spark, scan(docs, key, text, (owner,)).withColumn("row", F.monotonically_increasing_id()), "secrets")
    counts = ownership(spans, "row", owner)
    examples = counts.where((F.col("n_owners") >= example_owners) & (F.col("n_repos") >= example_repos)).select("value")
    each = spans.select("row", F.explode("spans").alias("span")).select("row", F.col("span.value").alias("value")).distinct()
    shown = each.join(examples, "value", "left_semi").groupBy("row").agg(F.collect_list("value").alias("examples"))
    judged = spans.join(shown, "row", "left")
    live = F.transform("spans", lambda s: F.struct(s["start"], s["end"], F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1).alias("kind"), s["value"].alias("value"), (~F.coalesce(F.array_contains("examples", s["value"]), F.lit(False))).alias("live")))
    return judged.select(key, "row", live.alias("spans"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract's columns: counts, the base spans' digest and all spans as text."""
    tell = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    stay = F.filter("spans", lambda s: s["kind"].isin(*BASE) | s["live"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        key, *(count(k).alias(f"n_{k}") for k in BASE), F.sha2(tell(base), 256).alias("base_sha256"), tell(stay).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"), F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_examples"),
    )


def redact(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """The documents with each live-looking span replaced by ``mark``; widely copied examples stay.

    Scans with ownership counts first, then walks the texts again: a text's live values are written and
    come with a join by key, which shuffles texts only where the spans are too many to broadcast;
    overlapping spans are replaced as one.
    """
    columns = docs.columns
    hashed = docs.withColumn("hash_", F.xxhash64(text))
    spots = find_secrets(spark, hashed.withColumn("key_", F.struct(F.col(key).alias("key"), "hash_")), "key_", text, **options)
    spots = spots.select("key_", F.filter("spans", lambda s: s["live"]).alias("spans")).where(F.size("spans") > 0)
    spots = spots.select(F.col("key_.key").alias("key_"), F.col("key_.hash_").alias("same_"), F.sort_array(F.transform("spans", lambda s: F.struct(s["start"], s["end"]))).alias("spots_")).dropDuplicates(["key_", "same_"])
    spots = small_first(written(spark, spots, "secret-spots"), F.size("spots_") + 1)
    joined = hashed.join(spots, F.col(key).eqNullSafe(F.col("key_")) & (F.col("hash_") == F.col("same_")), "left")
    step = lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(a["out"], F.substr(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at"),
    )
    cleaned = F.aggregate("spots_", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda a: F.concat(a["out"], F.substr(F.col(text), a["at"] + 1, F.length(F.col(text)))))
    clean = F.when(F.col("spots_").isNull(), F.col(text)).otherwise(cleaned)
    return joined.select(*(clean.alias(c) if c == text else F.col(c) for c in columns))
