"""Byte-level BPE, token files and packing against the tokenizer libraries."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe, tokens
from tessera.llm.common import shared_dir

BYTE, WORD = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_bpe_equals_the_library(docs, odd, tiktoken_encoding):
    got = bpe.encode_documents(docs(odd), BYTE, P.PATTERN).collect()
    want = []
    for key, text, *_ in odd:
        ids = tiktoken_encoding.encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.encode_documents(docs([]), BYTE, P.PATTERN).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é\n\t'st日🙂.1  A"), max_size=40), max_size=5))
def test_bpe_round_trip(tiktoken_encoding, texts):
    b = bpe.worker(BYTE, P.PATTERN)
    ids, sizes = b.texts.encode(texts)
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == [tiktoken_encoding.encode_ordinary(t) for t in texts]
    assert b.decode(ids, sizes) == [t.encode() for t in texts]


def test_remembered_keys_are_trimmed_by_use():
    r = bpe.Remembered(lambda keys: (np.array([len(k) for k in keys], np.uint32), np.ones(len(keys), np.int64)), most=20 * bpe.KEY_BYTES)
    for k in range(60):
        r.trim()
        words = ["often", "x" * (k % 7), *["u" * (100 + k) for _ in range(1)]]
        ids, sizes = r.get(np.array([r.index[w] for w in words]))
        assert ids.tolist() == [len(w) for w in words]
        assert sizes.tolist() == [1, 1, 1]
    assert len(r.index) <= 21
    assert "often" in r.index
    r.forget()
    assert len(r.index) == r.bytes == len(r.rows) == 0


class Told:
    """Passes everything on to ``what`` and keeps the arguments of one method."""

    def __init__(self, what, method: str):
        self.what, self.method, self.calls = what, method, []

    def __getattr__(self, name):
        found = getattr(self.what, name)
        return found if name != self.method else lambda *args: (self.calls.append(args), found(*args))[1]


def random_words(n: int, most: int) -> list[str]:
    rng = np.random.default_rng(11)
    return ["".join(rng.choice(list("etaoinshrdlué"), rng.integers(6, most))) for _ in range(n)]


def test_new_words_are_split_in_one_pass_and_take_one_row_each_of_the_query(tiktoken_encoding):
    b = bpe.Bpe(BYTE, P.PATTERN)
    b.pattern, b.db = Told(b.pattern, "findall"), Told(b.db, "register")
    text = " ".join(random_words(2000, 14)) + " don't  two\n\n lines\x1c\x85\u3000of 12ab?!\u2028"
    ids, _ = b.texts.encode([text, "", "\n", " ", "\n\nx\n y", "'s 's"])
    assert ids.tolist() == [x for t in (text, "\n", " ", "\n\nx\n y", "'s 's") for x in tiktoken_encoding.encode_ordinary(t)]
    assert len(b.pattern.calls) < 20
    rows = sum(seed.num_rows for name, seed in b.db.calls if name == "seed")
    assert 0 < rows < 2100  # a row a letter would be some 18,000


def test_a_pattern_that_takes_line_ends_splits_each_chunk_alone():
    import tiktoken

    pattern = r"""\p{L}+[\r\n]*| ?\p{N}+| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+(?!\S)|\s+"""
    ranks = bpe.load_ranks(BYTE)
    texts = ["ab!! cd?? 12 'x", "a\n b\n\n c", " ?\n"]
    ids, sizes = bpe.Bpe(BYTE, pattern).texts.encode(texts)
    encoding = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = [encoding.encode_ordinary(t) for t in texts]
    assert (ids.tolist(), sizes.tolist()) == (sum(want, []), [len(x) for x in want])


def test_queries_work_on_bounded_parts(tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "QUERY_BYTES", 5000)
    monkeypatch.setattr(bpe, "DECODE_IDS", 50)
    b = bpe.Bpe(BYTE, P.PATTERN)
    b.db = Told(b.db, "register")
    words = random_words(300, 60)
    texts = ["", " ".join(words[:200]), "", "a", " ".join(words[200:]), ""]
    ids, sizes = b.texts.encode(texts)
    assert ids.tolist() == [x for t in texts for x in tiktoken_encoding.encode_ordinary(t)]
    assert b.decode(ids, sizes) == [t.encode() for t in texts]
    assert b.decode(ids[:0], sizes[:0]) == []
    seeds, parts = ([t for name, t in b.db.calls if name == kind] for kind in ("seed", "ids"))
    assert len(seeds) > 100
    assert max(len(x.as_py()) for t in parts for x in t["places"]) <= 50


def test_a_document_of_millions_of_ids_is_decoded():
    b = bpe.worker(BYTE, P.PATTERN)
    ids = np.tile(b.byte[list(b"abc\xc3\xa9")].astype(np.uint32), 2_000_000)
    assert b.decode(ids, np.array([len(ids) - 5, 5])) == [b"abc\xc3\xa9" * 1_999_999, b"abc\xc3\xa9"]


def test_long_pieces_take_the_heap(tiktoken_encoding):
    b = bpe.worker(BYTE, P.PATTERN)
    letters = "".join(np.random.default_rng(3).choice(list("etaoinshrdlu"), 1 << 20))
    for text in ("a" * 2000, "abcab" * 300, "日本" * 400, letters[:600], letters):
        ids, _ = b.texts.encode([text])
        assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab É\n\t'sT日İΣ.1 ²<|>é\x1c "), max_size=30), max_size=5))
def test_word_encoder_equals_the_library(word_tokenizer, strings, texts):
    ids, sizes = tokens.worker(WORD).encode(strings(texts))
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == [x.ids for x in word_tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_new_words_are_cut_into_parts_in_one_pass(word_tokenizer):
    encoder, calls = tokens.WordEncoder(WORD), []
    found = encoder.parts

    class Counted:
        def findall(self, text):
            calls.append(len(text))
            return found.findall(text)

    encoder.parts = Counted()
    words = [f"{x}{i}{y}" for i in range(60) for x in ("it's", "<|", "\u023aB", "\u0130I", "\u00bd") for y in ("", "'ll,", "\u0301")] + ["\u5b57", "..."]
    ids, counts = encoder.encode_words(words)
    assert len(calls) == 1
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in word_tokenizer.encode_batch(words, add_special_tokens=False)]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 32), st.data())
def test_bit_packing(width, data):
    ids = np.array(data.draw(st.lists(st.integers(0, (1 << width) - 1), max_size=300)), np.uint32)
    packed = tokens.pack(ids, width)
    assert len(packed) == -(-len(ids) // 64) * 8 * width
    assert tokens.unpack(packed, len(ids), width).tolist() == ids.tolist()
    a = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - a))
    assert tokens.unpack(packed, n, width, a).tolist() == ids[a : a + n].tolist()


def test_token_files(spark, docs, odd, word_tokenizer):
    path = f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"
    got = tokens.token_files(spark, docs(odd), WORD, path=path).orderBy("start").collect()
    rows = sorted(((k, word_tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for k, t, *_ in odd), key=lambda r: (r[0] is not None, r[0] or 0))
    start, want, flat = 0, [], []
    for key, ids in rows:
        want.append((key, start, len(ids), crc(ids)))
        start += len(ids)
        flat += ids
    assert [tuple(r) for r in got] == want
    files = sorted((r["path"], bytes(r["content"])) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).collect())
    whole = np.concatenate([tokens.random_access(c, 0, 10**9) for _, c in files if c])
    assert whole.tolist() == flat
    biggest = max((c for _, c in files), key=len)
    every = tokens.random_access(biggest, 0, 10**9)
    assert tokens.random_access(biggest, 70, 100).tolist() == every[70:170].tolist()
    assert tokens.token_files(spark, docs([]), WORD).collect() == []


def test_files_follow_by_number_and_size(spark, docs, monkeypatch):
    names = [f"file:/x/part-{n:05d}-0b-c000.txt" for n in (0, 99_999, 100_000, 100_001, 2)]
    assert [tokens.file_number(n) for n in sorted(names, key=tokens.file_number)] == [0, 2, 99_999, 100_000, 100_001]
    monkeypatch.setattr(tokens, "FILE_BYTES", 2000)
    rows = [(7, f"one key with many texts {i}", "en", "a") for i in range(400)]
    path = f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"
    got = tokens.token_files(spark, docs(rows), WORD, path=path).orderBy("start").collect()
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got[:-1]]]).tolist()
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).where("length > 0").count()
    assert sizes > 3, "the rows of one key are divided as well"


def test_packing(spark, docs, odd, word_tokenizer):
    got = [r.asDict() for r in tokens.pack_sequences(spark, docs(odd), WORD, length=64).collect()]
    ids_of = {}
    for k, t, *_ in odd:
        ids_of[k] = word_tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    assert sum(r["length"] for r in got) == sum(len(ids_of[k]) for k, *_ in odd)
    for r in got:
        ids = ids_of[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids"] == ids[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == crc(r["ids"])
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 64 + offset == at, "gapless"
        assert offset + length <= 64
        at += length
    assert tokens.pack_sequences(spark, docs([]), WORD).collect() == []


@pytest.mark.parametrize("name, cached", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_are_the_library_s_for_any_tokenizer(strings, odd, name, cached):
    from tokenizers import Tokenizer

    path = P.path(name)
    encoder, library = tokens.WordEncoder(path), Tokenizer.from_file(path)
    assert encoder.by_words == cached
    texts = [t for _, t, _, _ in odd]
    ids, sizes = encoder.encode(strings(texts))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]
