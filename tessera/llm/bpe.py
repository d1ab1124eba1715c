"""Byte-level BPE encoding and decoding through DuckDB recursive queries in each task.

A text is cut into chunks at spaces before a non-space (a piece of the pattern never spans such a place), and
chunks that a worker has met before are looked up. The pieces of new chunks go to DuckDB, one row a piece with
the lists of its token ids and of the ranks of neighbours: a recursive query contracts, in every piece still open,
its leftmost pair of minimum rank and joins the two new pairs with the merge table, until no piece has a pair left.
Decoding joins the ids' byte strings in a query too. A piece that is itself in the vocabulary takes its id at
once, as the format asks.

Defined cases: null and empty texts have no ids and decode to nothing; repeated rows are encoded alike; extra
columns are ignored; texts without spaces are single chunks, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.common import bounded_batches, pieces_of, spread

#: Bytes (about) of chunks, and of pieces, that a task remembers; what it has forgotten it encodes anew.
CACHE_BYTES = 16 << 20
#: The same of the chunks, and of the pieces, that byte-level encoding remembers.
BPE_CACHE_BYTES = 32 << 20
#: Bytes (about) of one remembered key besides its letters and ids.
KEY_BYTES = 120
#: Of a piece of n bytes one recursive query holds the ids and ranks after each merge, at most some 4 n (n + 16) bytes. A query works on
#: so many bytes (one piece may have more).
QUERY_BYTES = 64 << 20
#: Ids that one query decodes.
DECODE_IDS = 1 << 20
#: Bytes of texts that are encoded and decoded at a time.
ENCODE_BYTES = 2 << 20
#: Bytes of a piece (no space, letters or signs only) beyond which its merges take a heap: the recursive query
#: holds a piece's ids after each merge, the square of its length.
LONG_PIECE = 512
#: Where two neighbours are no token.
NO_PAIR = 2147483647
#: Fixed value: the pattern that never lets a piece span a line end between two words; by any other, each chunk is split alone.
SEPARATED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ODD = re.compile(r" (?:\s|$)")


class Interned(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Rows:
    """Growing rows of integers, kept as one flat array with row starts."""

    def __init__(self):
        self.flat, self.ends, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used = len(self)
        if used + len(values) > len(self.flat):
            self.flat = np.resize(self.flat, max(2 * len(self.flat), used + len(values)))
        if self.n + len(lengths) > len(self.ends):
            self.ends = np.resize(self.ends, max(2 * len(self.ends), self.n + len(lengths)))
        self.flat[used : used + len(values)] = values
        self.ends[self.n : self.n + len(lengths)] = used + np.cumsum(lengths)
        self.n += len(lengths)

    def __len__(self) -> int:
        """Values in all rows."""
        return int(self.ends[self.n - 1]) if self.n else 0

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' values, one after the other, and their lengths."""
        ends = self.ends[rows]
        starts = np.where(rows > 0, self.ends[np.maximum(rows - 1, 0)], 0)
        return self.flat[spread(starts, ends - starts)], ends - starts


class Remembered:
    """Keys that a task has met, numbered, with the ids of each; ``encode`` gives the ids of new keys.

    Beyond ``most`` bytes those that were used least are forgotten, so that about half are left.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int = CACHE_BYTES):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.index, self.rows, self.used, self.bytes = Interned(), Rows(), np.zeros(0, np.int64), 0

    def trim(self) -> None:
        if self.bytes > self.most:
            least = 1 + int(np.partition(self.used, len(self.used) // 2)[len(self.used) // 2])
            keep = np.flatnonzero(self.used >= least)
            kept, rows = Interned(), Rows()
            keys = list(self.index)
            kept.update((keys[i], n) for n, i in enumerate(keep.tolist()))
            rows.add(*self.rows.get(keep))
            self.bytes = sum(map(len, kept)) + KEY_BYTES * len(kept) + 4 * len(rows)
            self.index, self.rows, self.used = kept, rows, self.used[keep] // 2

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, lengths) of the keys with these numbers; encodes what is new first."""
        if new := len(self.index) - self.rows.n:
            keys = [k for k, _ in zip(reversed(self.index), range(new), strict=False)][::-1]
            ids, lengths = self.encode(keys)
            self.rows.add(ids, lengths)
            self.bytes += sum(map(len, keys)) + KEY_BYTES * new + 4 * len(ids)
        used = np.bincount(numbers, minlength=len(self.index))
        used[: len(self.used)] += self.used
        self.used = used
        return self.rows.get(numbers)

    def grouped(self, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``get``, with the lengths of groups of ``sizes`` keys."""
        ids, lengths = self.get(numbers)
        return ids, np.diff(np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])])


class ChunkEncoder:
    """Encodes texts by chunks; ``encode_new`` gives the ids of chunks that have not been met yet."""

    def __init__(self, split: Callable[[str], list[str]], encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = CACHE_BYTES):
        self.split, self.chunks = split, Remembered(encode_new, most)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids, one after the other, and how many each text has."""
        self.chunks.trim()
        look, numbers, sizes = self.chunks.index.__getitem__, [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = self.split(text)
            numbers.append(np.fromiter(map(look, parts), np.int64, len(parts)))
            sizes[i] = len(parts)
        return self.chunks.grouped(np.concatenate(numbers), sizes)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every two tokens whose bytes together are a token: (l, r, rank)."""
    rows = [(ranks[t[:k]], ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    left, right, rank = np.array(rows, np.int64).reshape(-1, 3).T
    return pa.table({"pair": left * 65536 * 65536 + right, "rank": rank})


def by_space(text: str) -> list[str]:
    """Chunks that together are the text, each but the first with the space before it."""
    if not text:
        return []
    if " " not in text:
        return [text]
    if _ODD.search(text):
        return re.split(r"(?= \S)", text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]


ENCODE = """
WITH RECURSIVE t(w, toks, ranks, rank) AS (
  SELECT w, toks, ranks, list_min(ranks) FROM seed
  UNION ALL
  (WITH spot AS (SELECT *, list_position(ranks, rank) AS i FROM t WHERE rank < 2147483647),
  pairs AS (SELECT *, CASE WHEN i > 1 THEN toks[i - 1] * 4294967296 + rank END AS before, rank * 4294967296 + toks[i + 2] AS after FROM spot),
  met AS (
    SELECT w, toks, ranks, pairs.rank, i, coalesce(b.rank, 2147483647) AS before, coalesce(a.rank, 2147483647) AS after
    FROM pairs LEFT JOIN merges b ON b.pair = before LEFT JOIN merges a ON a.pair = after
  ),
  contracted AS (
    SELECT w, list_concat(toks[:i - 1], [rank], toks[i + 2:]) AS toks,
      CASE WHEN i > 1 THEN list_concat(ranks[:i - 2], [before, after], ranks[i + 2:]) ELSE list_concat([after], ranks[3:]) END AS ranks
    FROM met
  )
  SELECT w, toks, ranks, list_min(ranks) FROM contracted)
)
SELECT w, toks FROM t WHERE rank = 2147483647 ORDER BY w
"""

DECODE = "SELECT part, array_to_string(list_select(bytes, places), '') AS text FROM ids, vocabulary ORDER BY part"


class Bpe:
    """One worker's DuckDB with the merge table and the vocabulary, and what the running task remembers."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks, self.pattern = load_ranks(path), regex.compile(pattern)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": ""})
        merges, by_id = merge_table(self.ranks), {i: t.decode("latin-1") for t, i in self.ranks.items()}
        self.db.register("merges_", merges)
        self.db.register("vocabulary_", pa.table({"bytes": pa.array([[by_id.get(i) for i in range(max(by_id) + 1)]])}))
        self.pairs = dict(zip(merges["pair"].to_pylist(), merges["rank"].to_pylist(), strict=True))
        self.db.execute("CREATE TABLE merges AS SELECT pair, rank::INT AS rank FROM merges_; CREATE TABLE vocabulary AS FROM vocabulary_")
        self.byte_pairs = np.array([[self.pairs.get(a << 32 | b, NO_PAIR) for b in self.byte.tolist()] for a in self.byte.tolist()], np.int32)
        self.word = regex.compile(r" ?\S+") if pattern == SEPARATED else None
        self.pieces = Remembered(self.encode_pieces, BPE_CACHE_BYTES)
        self.texts = ChunkEncoder(by_space, self.encode_chunks, BPE_CACHE_BYTES)

    def forget(self) -> None:
        self.pieces.forget()
        self.texts.chunks.forget()

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number of each chunk; the pieces of all chunks that are one word are found in one pass, with a line end between chunks."""
        self.pieces.trim()
        look, sizes = self.pieces.index.__getitem__, np.zeros(len(chunks), np.int64)
        plain = np.fromiter(map(bool, map(self.word.fullmatch, chunks)), bool, len(chunks)) if self.word else np.zeros(len(chunks), bool)
        words = list(compress(chunks, plain))
        found = self.pattern.findall("\n".join(words))
        numbers = np.fromiter(map(look, found), np.int64, len(found))
        if words:
            between = numbers == look("\n")
            ends = np.append(np.flatnonzero(between), len(numbers))
            sizes[plain] = np.diff(ends, prepend=-1) - 1
            numbers = numbers[~between]
        if len(words) == len(chunks):
            return self.pieces.grouped(numbers, sizes)
        others = []
        for i in np.flatnonzero(~plain).tolist():
            found = self.pattern.findall(chunks[i])
            others += map(look, found)
            sizes[i] = len(found)
        both, own = np.zeros(int(sizes.sum()), np.int64), np.repeat(plain, sizes)
        both[own], both[~own] = numbers, others
        return self.pieces.grouped(both, sizes)

    def encode_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number of each piece; those that are tokens take their id, the others the query."""
        pieces = [t.encode("utf-8") for t in texts]
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        lengths = np.where(whole >= 0, 1, 0)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = np.array([len(p) for p in pieces], np.int64)
        for i in np.flatnonzero((whole < 0) & (size > LONG_PIECE)).tolist():
            tok = self.contract_long(pieces[i])
            lengths[i] = len(tok)
            held.append((np.array([i]), tok))
        left = np.flatnonzero((whole < 0) & (size <= LONG_PIECE))
        held_bytes = np.cumsum(4 * size[left] * (size[left] + 16))
        start = 0
        while start < len(left):
            stop = max(start + 1, int(np.searchsorted(held_bytes, QUERY_BYTES + (held_bytes[start - 1] if start else 0), "right")))
            part = left[start:stop]
            tok, lengths[part] = self.contract([pieces[i] for i in part.tolist()], size[part])
            held.append((part, tok))
            start = stop
        ends = np.cumsum(lengths)
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
        ready = whole >= 0
        ids[(ends - lengths)[ready]] = whole[ready]
        for part, tok in held:
            ids[spread((ends - lengths)[part], lengths[part])] = tok
        return ids, lengths

    def contract(self, pieces: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, lengths) of the pieces by the recursive query, which starts from their bytes' ids and the ranks of byte pairs."""
        data, offsets = np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        ranks = np.full(len(data), NO_PAIR, np.int32)
        ranks[:-1] = self.byte_pairs[data[:-1], data[1:]]
        ranks[offsets[1:] - 1] = NO_PAIR
        lists = [pa.ListArray.from_arrays(offsets, x) for x in (self.byte[data].astype(np.int32), ranks)]
        self.db.register("seed", pa.table([np.arange(len(pieces)), *lists], ["w", "toks", "ranks"]))
        toks = self.db.sql(ENCODE).to_arrow_table()["toks"].combine_chunks()
        self.db.unregister("seed")
        return pc.list_flatten(toks).to_numpy(zero_copy_only=False), pc.list_value_length(toks).to_numpy(zero_copy_only=False)

    def contract_long(self, piece: bytes) -> np.ndarray:
        """The same contraction for one very long piece: a heap of pairs by rank and place, tokens in a linked list."""
        tok = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(tok)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        rank_of = lambda i: self.pairs.get(tok[i] << 32 | tok[after[i]]) if after[i] >= 0 else None
        heap = [r << 32 | i for i in range(n) if (r := rank_of(i)) is not None]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), 1 << 32)
            if tok[i] < 0 or rank_of(i) != rank:  # merged since, here or with its left neighbour
                continue
            gone = after[i]
            tok[i], tok[gone], after[i] = rank, -1, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank_of(k)) is not None:
                    heappush(heap, r << 32 | k)
        return np.array([t for t in tok if t >= 0], np.int64)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of each document's ids; a query decodes parts of at most ``DECODE_IDS`` ids in all."""
        ends = np.cumsum(sizes)
        cuts = np.union1d(np.append(0, ends), np.arange(0, len(ids), DECODE_IDS)).astype(np.int64)
        parts: list[bytes] = []
        start = 0
        while start < len(cuts) - 1:
            stop = max(start + 1, int(np.searchsorted(cuts, cuts[start] + DECODE_IDS, "right")) - 1)
            lists = pa.ListArray.from_arrays((cuts[start : stop + 1] - cuts[start]).astype(np.int32), ids[cuts[start] : cuts[stop]].astype(np.int64) + 1)
            self.db.register("ids", pa.table([np.arange(stop - start), lists], ["part", "places"]))
            parts += [text.encode("latin-1") for text in self.db.sql(DECODE).to_arrow_table()["text"].to_pylist()]
            self.db.unregister("ids")
            start = stop
        at = np.searchsorted(cuts, np.append(0, ends))
        return [b"".join(parts[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_WORKER: dict[tuple[str, str], Bpe] = {}


def worker(path: str, pattern: str) -> Bpe:
    """This Python worker's tables; they serve all tasks that the worker runs."""
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = Bpe(path, pattern)
    return _WORKER[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_tokens, ids_sha256, decoded_sha256) in the order of the input; no shuffle."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker(path, pattern)
        try:
            for whole in batches:
                for batch in pieces_of(whole, "text_", ENCODE_BYTES):
                    texts = [t or "" for t in batch.column(1).to_pylist()]
                    ids, sizes = bpe.texts.encode(texts)
                    ends, flat = np.cumsum(sizes), ids.astype("<u4")
                    hashes = [hashlib.sha256(flat[e - n : e].tobytes()).hexdigest() for e, n in zip(ends, sizes, strict=True)]
                    back = [hashlib.sha256(b).hexdigest() for b in bpe.decode(ids, sizes)]
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(hashes), pa.array(back)], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            bpe.forget()

    bounded_batches(docs.sparkSession)
    from pyspark.sql import functions as F

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).alias("text_")).mapInArrow(encoded, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
