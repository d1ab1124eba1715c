"""N-gram Jaccard join with PartEnum signatures, and the classes of linked documents.

Sets whose sizes lie in one band and whose Jaccard similarity reaches the threshold differ in at most ``k``
elements. The shingle domain is cut by hash into ``n1`` partitions of ``n2`` parts; at least one partition then
holds at most ``k2`` differences, so some subset of ``n2 - k2`` of its parts is equal in both sets. A signature
is the hash of one such subset of parts: band, partition, subset and the elements in it. A set takes part in its
own band and in lower bands whose sets it may still resemble, so every linked pair shares a signature.

Large buckets are met only where they must be. More partitions are cut than needed, so that a linked pair shares
more than ``spare`` signatures of a band. All signatures have one order: by the number of sets that hold them,
over the whole corpus, ties by value, those without elements last. Every set leaves out its ``spare`` last ones:
the first signature that a linked pair shares has at least ``spare`` shared ones behind it, so it stays in both.

Equal sets are one node from the start, and buckets of the same members are one bucket. In every bucket the set
with most neighbours (the original, in a family of edited copies) is compared with all others (a star), and
components are formed. Then the pairs of a bucket that are still in different components are met in a join whose
condition bounds their difference from below: two bitmaps of ``SKETCH`` bits, each bit the parity of the shingles
that fall on it, differ in at most as many bits as the sets do in elements. Only pairs that the bound doesn't
exclude come out of that join and are compared. So no link between different components is lost, while copies
are never expanded into all pairs. Comparisons take whole sets, in groups that are split by the size of the sets.

Shingles are 64-bit hashes of their words' hashes: results are exact but for collisions of these.

Defined cases: null texts and texts without words have an empty set and link with nothing; rows with a null key
get a null component; rows with the same key are one node; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import shingles
from tessera.llm.common import bounded_batches, components, discard, mix64, pieces_of, small_first, written

#: Shingles (about) of the partners of one set that are compared in one group.
GROUP = 1 << 17
#: Bits of a set's parity bitmap.
SKETCH = 1024
WORDS = [f"p{i}" for i in range(SKETCH // 64)]


@dataclass(frozen=True)
class PartEnum:
    """Bands and partitions for similarity >= num / den; bands grow by ``ratio``."""

    num: int = 85
    den: int = 100
    ratio: float = 1.6
    n2: int = 2
    k2: int = 1
    spared: float = 0.15  #: the share of signatures that a linked pair has in common at least

    def reach(self, size: int) -> int:
        """The largest size that a set of this size may still resemble."""
        return size * self.den // self.num

    def differences(self, a: int, b: int) -> int:
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def agreeing(self, n1: int, k: int) -> int:
        """Signatures that two sets share at least: k differences spoil most when spread evenly over the partitions."""
        each, more = divmod(k, n1)
        left = lambda d: comb(self.n2 - d, self.n2 - self.k2) if d <= self.k2 else 0
        return (n1 - more) * left(each) + more * left(each + 1)

    def bands(self, largest: int) -> list[tuple[int, int, int, int]]:
        """(first size, last size, n1, spare) of each band up to ``largest``."""
        out, low = [], 1
        while low <= largest:
            high = max(low, int(low * self.ratio) - 1)
            k, n1, spare = self.differences(high, self.reach(high)), 0, 0
            if k:  # else only equal sets link
                n1 = k // (self.k2 + 1) + 1
                while (spare := self.agreeing(n1, k) - 1) < self.spared * n1 * comb(self.n2, self.k2):
                    n1 += 1
            out.append((low, high, n1, spare))
            low = high + 1
        return out


def signatures(hashes: np.ndarray, sizes: np.ndarray, scheme: PartEnum) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(signature, place of its set, band, how many more the set may leave out in it) for sets of ascending hashes.

    Signatures without elements are last in the common order, so they are left out here, as far as may be.
    """
    none = np.zeros(0, np.int64)
    if not len(sizes) or not sizes.max():
        return none, none, none, none
    bands = scheme.bands(int(sizes.max()))
    subsets = list(combinations(range(scheme.n2), scheme.n2 - scheme.k2))
    ends = np.cumsum(sizes)
    found, of, in_band, may_drop = [none], [none], [none], [none]
    for b, (low, high, n1, spare) in enumerate(bands):
        if not n1:
            continue
        sets = np.flatnonzero((sizes >= low) & (sizes <= scheme.reach(high)))
        if not len(sets):
            continue
        n = sizes[sets]
        at = np.arange(int(n.sum())) + np.repeat(ends[sets] - n - (np.cumsum(n) - n), n)
        h = hashes[at]
        cells = np.uint64(n1 * scheme.n2)
        cell = (((h >> np.uint64(32)) * cells) >> np.uint64(32)).astype(np.int64) + np.repeat(np.arange(len(sets)), n) * int(cells)
        border = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        total = np.zeros(len(sets) * int(cells), np.uint64)
        total[cell[border]] = np.add.reduceat(mix64(h), border)
        total = total.reshape(len(sets), n1, scheme.n2)
        value = np.zeros((len(subsets), len(sets), n1), np.uint64)
        empty = np.zeros(value.shape, bool)
        for j, subset in enumerate(subsets):
            one = total[:, :, subset[0]].copy()
            for x in subset[1:]:
                one = mix64(one) + total[:, :, x]
            place = np.uint64(b << 40 | j << 32) + np.arange(n1, dtype=np.uint64)
            value[j] = mix64(one + mix64(place)[None, :])
            empty[j] = (total[:, :, subset] == 0).all(2)
        value, empty = (np.moveaxis(x, 0, 2).reshape(len(sets), -1) for x in (value, empty))
        nothing = empty.sum(1)
        # of a set's empty signatures, in ascending order, all go but those that exceed what it may leave out
        held = np.where(empty, value.view(np.int64), np.iinfo(np.int64).max)
        rank = np.zeros(value.shape, np.int64)
        for i in np.flatnonzero(nothing > spare):
            rank[i, np.argsort(held[i], kind="stable")] = np.arange(value.shape[1])
        emit = ~empty | (rank < (nothing - spare)[:, None]) & (nothing > spare)[:, None]
        s, p = np.nonzero(emit)
        found.append(value[s, p].view(np.int64))
        of.append(sets[s])
        in_band.append(np.full(len(s), b))
        may_drop.append(np.maximum(spare - nothing, 0)[s])
    return np.concatenate(found), np.concatenate(of), np.concatenate(in_band), np.concatenate(may_drop)


def parities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sets, SKETCH / 64) words: each bit is the parity of the set's hashes that end in its number."""
    out = np.zeros((len(sizes), SKETCH // 64), np.int64)
    ends = np.cumsum(sizes)
    for a in range(0, len(sizes), 1024):
        n = sizes[a : a + 1024]
        first = int(ends[a] - sizes[a])
        at = np.repeat(np.arange(len(n)), n) * SKETCH + (hashes[first : first + int(n.sum())] % np.uint64(SKETCH)).astype(np.int64)
        odd = (np.bincount(at, minlength=len(n) * SKETCH) & 1).astype(np.uint8)
        out[a : a + 1024] = np.packbits(odd).view(np.int64).reshape(len(n), -1)
    return out


def _verify(spark: SparkSession, docs: DataFrame, pairs: DataFrame, size: int, scheme: PartEnum) -> DataFrame:
    """The pairs (a, b) of ``pairs`` (a, b, n: size of b) whose whole sets reach the threshold, written.

    The partners of one a are dealt to groups of about GROUP shingles.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.sum("n") / GROUP).cast("int").alias("salts"))
    members = pairs.join(groups, "a").select(F.col("b").alias("doc"), F.col("a").alias("center"), F.pmod(F.xxhash64("b"), F.col("salts").cast("long")).cast("int").alias("salt"))
    centers = groups.select(F.col("a").alias("doc"), F.col("a").alias("center"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    wanted = small_first(written(spark, members.unionByName(centers), "wanted"))
    texts = docs.join(wanted, "doc").select("doc", "text", "center", "salt")

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "text"):
                hashes, sizes = shingles.sets(batch.column(1), size)
                ends = np.cumsum(sizes)
                data = pa.array([hashes[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), data], ["doc", "center", "salt", "set"])

    def compared(group: pa.Table) -> pa.Table:
        doc, center = group["doc"].to_numpy(), group["center"][0].as_py()
        held = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["set"].combine_chunks()] if group.num_rows else []
        own = [s for d, s in zip(doc, held, strict=True) if d == center]
        out = set()
        for d, s in zip(doc, held, strict=True):
            for o in own if d != center else ():
                small, large = (s, o) if len(s) < len(o) else (o, s)
                if not len(small):
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                if both * scheme.den >= scheme.num * (len(s) + len(o) - both):
                    out.add(int(d))
        return pa.table({"a": pa.array([center] * len(out), pa.int64()), "b": pa.array(sorted(out), pa.int64())})

    linked = texts.mapInArrow(as_sets, "doc long, center long, salt int, set binary").groupBy("center", "salt").applyInArrow(compared, "a long, b long")
    return written(spark, linked, "links")


def signed_rows(docs: DataFrame, size: int, scheme: PartEnum) -> DataFrame:
    """Rows (sig, node, band, left): signatures of the distinct sets of each task, a set named by its first digest."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in pieces_of(whole, "text"):
                hashes, sizes = shingles.sets(batch.column(1), size)
                node = shingles.digests(hashes, sizes)[0]
                fresh = np.array(batch.column(0).is_valid()) & (sizes > 0)
                for i in np.flatnonzero(fresh):
                    fresh[i] = (d := int(node[i])) not in seen
                    seen.add(d)
                value, of, band, left = signatures(hashes[np.repeat(fresh, sizes)], np.where(fresh, sizes, 0), scheme)
                for a in range(0, len(value), 1 << 17):
                    part = slice(a, a + (1 << 17))
                    yield pa.RecordBatch.from_arrays([pa.array(value[part]), pa.array(node[of[part]]), pa.array(band[part].astype(np.int32)), pa.array(left[part].astype(np.int32))], ["sig", "node", "band", "left"])

    return docs.mapInArrow(signed, "sig long, node long, band int, left int")


def buckets(spark: SparkSession, signed: DataFrame) -> DataFrame:
    """Rows (sig, node): the buckets in which linked sets meet, each group of members once.

    Sizes are counted with map-side sums and joined; they grow with the input, so that join always sorts and merges.
    Then each set's signatures of a band, no more than its own elements, are put in order and the last ones left out.
    """
    signed = written(spark, signed, "signed")
    # written first: its shuffle has gone from the disk when that of the join comes
    sizes = written(spark, signed.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    shared = written(spark, signed.join(sizes.hint("merge"), "sig"), "shared")
    discard(spark, signed)
    ordered = shared.groupBy("node", "band").agg(F.max("left").alias("left"), F.sort_array(F.collect_set(F.struct("size", "sig"))).alias("all"))
    kept = ordered.where(F.size("all") > F.col("left")).select("node", F.explode(F.slice("all", 1, F.size("all") - F.col("left"))["sig"]).alias("sig"))
    kept = written(spark, kept, "kept")
    discard(spark, shared)
    members = kept.groupBy("sig").agg(F.count(F.lit(1)).alias("members"), *(F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"x{k}") for k in (1, 2))).where("members > 1")
    once = members.groupBy("members", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig")
    return written(spark, kept.join(once, "sig"), "buckets")


def jaccard_classes(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, scheme: PartEnum | None = None) -> DataFrame:
    """Rows (key, n_shingles, component_id), one per row of ``docs``."""
    scheme = scheme or PartEnum()
    bounded_batches(spark)
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "text"):
                hashes, sizes = shingles.sets(batch.column(1), size)
                d1, d2 = shingles.digests(hashes, sizes)
                bits = parities(hashes, sizes)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(d1), pa.array(d2), *map(pa.array, np.ascontiguousarray(bits.T))], ["doc", "n", "d1", "d2", *WORDS])

    schema = ", ".join(f"{c} long" for c in ["doc", "n", "d1", "d2", *WORDS])
    table = written(spark, docs.mapInArrow(described, schema), "sets")
    sets = table.where("n > 0 and doc is not null").groupBy("d1", "d2", "n").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"), *(F.max(w).alias(w) for w in WORDS))
    sets = written(spark, sets, "classes")  # a set's name is its smallest document's id
    repeated = sets.where("copies > 1").select("d1", "d2", "n", "rep")
    reps = written(spark, table.select("doc", "n", "d1", "d2").join(repeated, ["d1", "d2", "n"], "left").select("doc", "n", F.coalesce("rep", "doc").alias("rep")), "reps")
    of_doc = reps.where("doc is not null and n > 0").groupBy("doc").agg(F.min("rep").alias("rep"))

    found = buckets(spark, signed_rows(docs, size, scheme))
    named = sets.select(F.col("d1").alias("node"), F.col("rep").alias("doc"), "n")
    rows = written(spark, found.join(named, "node").select("sig", "doc", "n"), "members")
    crowd = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    weight = rows.join(crowd, "sig").groupBy("doc").agg(F.sum("size").alias("shared"))
    most = F.struct("shared", -F.col("doc"))
    # written, so that Spark can split the join where a bucket is large
    centers = written(spark, rows.join(weight, "doc").groupBy("sig").agg(F.max_by("doc", most).alias("center"), F.max_by("n", most).alias("center_n")), "centers")
    others = written(spark, rows.join(centers, "sig").where("doc <> center"), "others")
    star = others.where(_alike(F.col("n"), F.col("center_n"), scheme)).select(F.col("center").alias("a"), F.col("doc").alias("b"), "n").distinct()
    links = _verify(spark, docs, star, size, scheme)
    same = reps.where("n > 0").join(of_doc.withColumnRenamed("rep", "first"), "doc").where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b"))
    links = links.unionByName(written(spark, same.distinct(), "same"))  # texts of one key
    joined = components(spark, links)

    open_ = others.drop("center", "center_n").join(joined.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))  # centers have been compared with all
    open_ = written(spark, open_, "open")
    mixed = open_.groupBy("sig").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("sig")
    mixed = written(spark, mixed, "mixed")
    open_ = written(spark, open_.join(mixed, "sig").join(sets.select(F.col("rep").alias("doc"), "n", *WORDS), ["doc", "n"]), "open")
    x, y = open_.alias("x"), open_.alias("y")
    differ = " + ".join(f"bit_count(x.{w} ^ y.{w})" for w in WORDS)
    few = F.expr(f"({differ}) * {scheme.num + scheme.den} <= {scheme.den - scheme.num} * (x.n + y.n)")
    near = F.expr("x.sig = y.sig and x.doc < y.doc and x.component <> y.component") & _alike(F.col("x.n"), F.col("y.n"), scheme) & few
    pairs = written(spark, x.join(y, near).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"), F.col("y.n").alias("n")).distinct(), "pairs")
    if pairs.limit(1).count():
        more = _verify(spark, docs, pairs, size, scheme)
        if more.limit(1).count():
            joined = components(spark, links.unionByName(more))
    labels = of_doc.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("doc", F.coalesce("component", "rep").alias("component"))
    return reps.join(labels, "doc", "left").select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def _alike(a: Column, b: Column, scheme: PartEnum) -> Column:
    """Sizes that allow for a link."""
    return F.least(a, b) * scheme.den >= F.greatest(a, b) * scheme.num


ORACLE_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END)) AS s
  FROM cut
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS held FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * held >= 85 * (p.n + q.n - held)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.node, edges.b FROM reach JOIN edges ON reach.seen = edges.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
