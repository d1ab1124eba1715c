"""Token ids: a word-level encoder, fixed-width bit-packed files, and concatenate-and-cut packing.

Texts are encoded with the tokenizers library. White space separates that tokenizer's words and is dropped, so
a text's ids are its words' ids one after the other; a task remembers the words it has met. Words of plain
letters, digits and signs go to the library's BPE model, all others through its whole encoder.

Files: a file is a run of blocks, each followed by a line feed, then one footer. A block holds a header, the
keys and token counts of its documents, and their ids in ``width`` bits each (the fewest that hold the
vocabulary), 64 ids in ``width`` little-endian 64-bit words. The footer lists each block's byte offset and
first id, so a reader can seek to any id and unpack with array shifts. Spark writes and reads the files, so
they can lie in any store and a lost task's output is never seen.

Defined cases: null and empty texts have no ids but the end id; a null key sorts first; rows with the same key
follow each other by a hash of their texts; an empty table writes no block; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import ChunkEncoder, Remembered
from tessera.llm.common import bounded_batches, pieces_of, shared_dir, shuffle_partitions, spread, utf8, written

#: Ids of one block, unless a single document has more.
BLOCK_IDS = 1 << 16
#: Bytes of the texts of one file, about.
FILE_BYTES = 128 << 20
_BLOCK = struct.Struct("<4sBxxxIQ")
_ENTRY = struct.Struct("<QQI")
_END = struct.Struct("<I4s")


# ---------------------------------------------------------------- encoding


#: Below it no letters compose; the letters there are the cache's own.
LATIN = 0x300
#: The normalizer and splitter that the word cache reproduces; any other tokenizer encodes whole texts.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTERS = [
    {"type": "Split", "pattern": {"Regex": PARTS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def splits_words(settings: dict) -> bool:
    """Whether a tokenizer file normalizes and splits as the word cache does, with added tokens that hold ``<``, ``|`` or ``>``."""
    same = settings["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS} and settings["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": SPLITTERS}
    return same and all(set(t["content"]) & set("<|>") and t["content"].split() == [t["content"]] for t in settings["added_tokens"])


class WordEncoder:
    """One worker's tokenizer with the words and word parts that it has met."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.by_words = splits_words(json.load(f))
        met = sorted({x for c in range(LATIN) for x in chr(c) + chr(c).lower()})
        letters, digits = ("".join([re.escape(x) for x in met if regex.match(kind, x)]) for kind in (r"\p{L}", r"\p{N}"))
        self.parts = re.compile(PARTS.replace(r"\p{L}", letters).replace(r"\p{N}", digits) + "| ")  # the same to plain letters, in half the time
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.letters = [chr(b) if b in printable else chr(next(others)) for b in range(256)]  # byte-level alphabet
        self.plain = np.array([c == 32 or (chr(c) not in "<|>" and unicodedata.category(chr(c)) != "Cc" and not chr(c).isspace()) for c in range(LATIN)] + [False])
        self.texts = ChunkEncoder(str.split, self.encode_words)
        self.known = Remembered(self.encode_parts)

    def forget(self) -> None:
        self.texts.chunks.forget()
        self.known.forget()

    def encode(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string array's texts and how many each text has."""
        data = utf8(array)[0]
        texts = [t or "" for t in array.to_pylist()]
        if not self.by_words:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([x for r in ids for x in r], np.uint32), np.array([len(r) for r in ids], np.int64)
        if len(data) and data.max() < 0xCC and not (data == ord("<")).any():  # below U+0300 nothing composes
            texts = [t.lower() for t in texts]
        if len(data) and ((data >= 0x1C) & (data <= 0x1F)).any():  # white space to Python only
            self.texts.split = lambda t: t.split(" ")
        ids, sizes = self.texts.encode(texts)
        self.texts.split = str.split
        return ids, sizes

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without spaces; the parts of all plain ones are found in one pass, with a space between words."""
        self.known.trim()
        joined = " ".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        strange = np.flatnonzero(~self.plain[np.minimum(points, len(self.plain) - 1)])
        odd = np.unique(np.searchsorted(np.flatnonzero(points == 32), strange))
        if len(odd):
            whole = [words[i] for i in odd]
            left = words.copy()
            for i in odd:
                left[i] = ""
            joined = " ".join(left)
        found = self.parts.findall(joined.lower())
        look = self.known.index.__getitem__
        space = look(" ")
        numbers = np.fromiter(map(look, found), np.int64, len(found))
        ends = np.append(np.flatnonzero(numbers == space) + 1, len(numbers))[: len(words)]
        flat, counts = self.known.grouped(numbers, np.diff(ends, prepend=0))
        if len(odd):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
            counts[odd] = [len(r) for r in ids]
            out, own = np.zeros(int(counts.sum()), np.uint32), np.ones(int(counts.sum()), bool)
            at = spread((np.cumsum(counts) - counts)[odd], counts[odd])
            own[at] = False
            out[at], out[own] = [x for r in ids for x in r], flat
            flat = out
        return flat.astype(np.uint32), counts

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of plain letters, digits or signs, by the library's model; the space between words has none."""
        ids = [[t.id for t in self.model.tokenize(part if part.isascii() else "".join([self.letters[b] for b in part.encode()]))] if part != " " else [] for part in parts]
        return np.array([x for r in ids for x in r], np.uint32), np.array([len(r) for r in ids], np.int64)


_WORKER: dict[str, WordEncoder] = {}


def worker(path: str) -> WordEncoder:
    """This Python worker's tokenizer; it serves all tasks that the worker runs."""
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents' ids with ``end`` after each."""
    out = np.full(len(ids) + len(sizes), end, np.uint32)
    out[spread(np.cumsum(sizes + 1) - (sizes + 1), sizes)] = ids
    return out, sizes + 1


# ---------------------------------------------------------------- bit packing


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits an id: each 64 ids become ``width`` words."""
    rows = -(-len(ids) // 64)
    lanes = np.zeros((rows, 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((rows, width), np.uint64)
    for lane in range(64):
        word, bit = divmod(lane * width, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(bit)
        if bit + width > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - bit)
    return words.astype("<u8").tobytes()


def unpack(data: bytes | memoryview, n: int, width: int, first: int = 0) -> np.ndarray:
    """Ids ``first`` to ``first + n`` of packed data, touching only their 64-id rows."""
    top, rows = first // 64, -(-(first + n) // 64)
    words = np.frombuffer(data, "<u8", (rows - top) * width, top * width * 8).reshape(-1, width)
    lanes = np.zeros((rows - top, 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for lane in range(64):
        word, bit = divmod(lane * width, 64)
        lanes[:, lane] = words[:, word] >> np.uint64(bit)
        if bit + width > 64:
            lanes[:, lane] |= words[:, word + 1] << np.uint64(64 - bit)
    return (lanes & mask).reshape(-1)[first - top * 64 : first - top * 64 + n].astype(np.uint32)


def block(keys: list[int | None], counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    head = _BLOCK.pack(b"TKB1", width, len(keys), len(ids))
    held = np.array([k or 0 for k in keys], "<i8").tobytes() + np.array([k is None for k in keys], np.uint8).tobytes()
    return head + held + counts.astype("<u8").tobytes() + pack(ids, width)


def read_block(data: memoryview) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    magic, width, n_docs, n_ids = _BLOCK.unpack_from(data)
    if magic != b"TKB1":
        raise ValueError("not a block of token ids")
    at = _BLOCK.size
    keys = np.frombuffer(data, "<i8", n_docs, at).tolist()
    none = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
    counts = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    return [None if x else k for k, x in zip(keys, none, strict=True)], counts, unpack(data[at + 17 * n_docs :], n_ids, width)


def footer(entries: list[tuple[int, int, int]]) -> bytes:
    """Entries: byte offset, ids before, documents of each block."""
    return b"".join(_ENTRY.pack(*e) for e in entries) + _END.pack(len(entries), b"TKF1")


def read_footer(data: memoryview) -> list[tuple[int, int, int]]:
    n, magic = _END.unpack_from(data, len(data) - 1 - _END.size)
    if magic != b"TKF1":
        raise ValueError("not a file of token ids")
    return list(_ENTRY.iter_unpack(data[len(data) - 1 - _END.size - n * _ENTRY.size : len(data) - 1 - _END.size]))


def random_access(data: bytes, first: int, n: int) -> np.ndarray:
    """Ids ``first`` to ``first + n`` of a file, read from the blocks that hold them only."""
    view, out = memoryview(data), []
    entries = read_footer(view)
    starts = np.array([e[1] for e in entries])
    for k in range(max(0, int(np.searchsorted(starts, first, "right")) - 1), len(entries)):
        at, before, n_docs = entries[k]
        _, width, _, n_ids = _BLOCK.unpack_from(view, at)
        a, b = max(first, before), min(first + n, before + n_ids)
        if a < b:
            out.append(unpack(view[at + _BLOCK.size + 17 * n_docs :], b - a, width, a - before))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def file_number(path: str) -> int:
    """The number of the partition that wrote a file; names have five digits or more."""
    return int(re.search(r"part-(\d+)", path.rpartition("/")[2])[1])


def write_files(docs: DataFrame, tokenizer: str, end: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` and write their ids in ascending key order, one file a range partition.

    The ranges are as many as texts hold ``FILE_BYTES``, so that a file can be read whole. Rows of one key, or of
    none, are ordered by a hash of their texts, which also divides their ranges.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker(tokenizer)
        entries, offset, before = [], 0, 0
        keys: list[int | None] = []
        counts: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal offset, before, keys, counts, held
            ids = np.concatenate(held)
            data = block(keys, np.concatenate(counts), ids, encoder.width)
            entries.append((offset, before, len(keys)))
            offset, before = offset + len(data) + 1, before + len(ids)
            keys, counts, held = [], [], []
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        try:
            for whole in batches:
                for batch in pieces_of(whole, "text_"):
                    ids, sizes = with_end(*encoder.encode(batch.column(1)), end)
                    keys += batch.column(0).to_pylist()
                    counts.append(sizes)
                    held.append(ids)
                    if sum(map(len, held)) >= BLOCK_IDS:
                        yield from flush()
            if keys:
                yield from flush()
            if entries:
                yield pa.RecordBatch.from_arrays([pa.array([footer(entries)], pa.binary())], ["data"])
        finally:
            encoder.forget()

    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("hash_"), F.col(text).alias("text_"))
    size = rows.agg(F.sum(F.octet_length("text_").cast("long"))).head()[0] or 0
    files = max(shuffle_partitions(spark), -(-size // FILE_BYTES))
    order = [F.col("key").asc_nulls_first(), F.col("hash_"), F.col("text_")]
    rows = rows.repartitionByRange(files, *order[:2]).sortWithinPartitions(*order).select("key", "text_")
    # a limit of rows a file would part a file from its footer
    rows.mapInArrow(blocks, "data binary").select(F.col("data").cast("string").alias("value")).write.option("compression", "none").option("maxRecordsPerFile", 0).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, key, before, n_tokens, ids_crc32): each file's documents; ``before`` counts in the file."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                view = memoryview(data.as_buffer())
                for at, before, _ in read_footer(view) if len(view) else ():
                    keys, counts, ids = read_block(view[at:])
                    ends = np.cumsum(counts)
                    flat = ids.astype("<u4")
                    crc = [zlib.crc32(flat[e - n : e]) for e, n in zip(ends, counts, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(before + ends - counts), pa.array(counts), pa.array(crc, pa.int64())], ["file", "key", "before", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    return files.mapInArrow(documents, "file string, key long, before long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int = 1, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Rows (key, start, n_tokens, ids_crc32) as read from the written files.

    ``start`` adds the totals of the files before, which Spark numbers in key order; one row a file (its
    name and total) reaches the driver for that.
    """
    path = path or f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_files(docs, tokenizer, end, path, key, text)
    rows = written(spark, read_files(spark, path), "token-rows")
    totals = sorted((file_number(r["file"]), r["file"], r["n"]) for r in rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    bases, total = [], 0
    for _, file, n in totals:
        bases.append((file, total))
        total += n
    return rows.join(spark.createDataFrame(bases, "file string, base long"), "file").select(F.col("key").alias(key), (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


# ---------------------------------------------------------------- packing


def pack_sequences(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int = 2, length: int = 4096, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Rows (key, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids array<int>): pieces of all documents.

    A digest that needs no ids leaves them out by ``with_ids=False``.

    Pass one encodes each partition and counts; ids go to the shared folder with the partition's number and
    each document's place in it. The partitions' totals (one row each) give global offsets by a prefix sum, and
    pass two cuts the concatenation at every multiple of ``length``: a document over a border has a piece on
    either side. Only the last sequence has padding.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, before = worker(tokenizer), TaskContext.get().partitionId(), 0
        try:
            for whole in batches:
                for batch in pieces_of(whole, "text_"):
                    ids, sizes = with_end(*encoder.encode(batch.column(1)), end)
                    ends = np.cumsum(sizes)
                    data = ids.astype("<u2" if encoder.width <= 16 else "<u4")
                    rows = pa.array([data[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(sizes), part, np.int32)), pa.array(before + ends - sizes), pa.array(sizes), rows], ["key", "part", "before", "n", "ids"])
                    before += int(ends[-1]) if len(ends) else 0
        finally:
            encoder.forget()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column(1).to_numpy()
            sizes = batch.column(2).to_numpy()
            out = {k: [] for k in ("row", "start", "length", "crc")}
            held: list[np.ndarray] = [np.zeros(0, "<u4")]
            for i, (data, a, n) in enumerate(zip(batch.column(3), first, sizes, strict=True)):
                raw = data.as_buffer()
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                if with_ids:
                    held.append(ids)
                edges = [0, *range(int(-a % length) or length, int(n), length), int(n)]
                for x, y in zip(edges, edges[1:], strict=False):
                    out["row"].append(i)
                    out["start"].append(x)
                    out["length"].append(y - x)
                    out["crc"].append(zlib.crc32(ids[x:y]))
            row, start, size = (np.array(out[k], np.int64) for k in ("row", "start", "length"))
            at = first[row] + start
            columns = [batch.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (start, size, out["crc"], sizes[row], at // length, at % length))]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(np.concatenate(held).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: len(columns)])

    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text_")).mapInArrow(encoded, f"key {kind}, part int, before long, n long, ids binary")
    rows = written(spark, rows, "token-ids")
    bases, total = [], 0
    for part, n in sorted(rows.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        bases.append((part, total))
        total += n
    placed = rows.join(F.broadcast(spark.createDataFrame(bases, "part int, base long")), "part")  # a row a partition
    placed = placed.select("key", (F.col("base") + F.col("before")).alias("first"), "n", "ids")
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long{', ids array<int>' if with_ids else ''}"
    return placed.mapInArrow(cut, schema).withColumnRenamed("key", key)
