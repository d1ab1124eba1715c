"""The pipeline's stages on a small corpus, and what they do to it, against plain Python."""

from __future__ import annotations

import os
import random

import public_tokenizers
import pytest

import corpus_pipeline as cp

DATA = "/root/testdata/sf0.001"


def test_stages_are_as_declared():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "language_id", "near_copies", "secrets", "packing"]
    assert cp.ORACLE_SQL is None


@pytest.fixture(scope="module")
def corpus(spark, docs, tmp_path_factory):
    rng = random.Random(1)
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    english = [a + b for a in ("th", "wh", "st", "br", "gr") for b in ("e", "is", "at", "own", "ing", "ough", "and")]
    german = [a + b for a in ("sch", "pf", "kn", "zw", "gl") for b in ("ei", "ung", "auch", "über", "enz", "ach", "icht")]
    rows = []
    for i in range(200):
        rows.append((i, say(english if i % 3 else german, 60), "en" if i % 3 else "de", f"s{i % 5}"))
    toxic = {i for i in range(200) if i % 7 == 0}
    rows = [(i, t + " moronface idiotic moronface" if i in toxic else t, lang, s) for i, t, lang, s in rows]
    rows += [(300, rows[1][1], "en", "s9"), (301, rows[1][1] + " tail", "en", "s8"), (302, "12 34 !!", "en", "s1"), (303, None, "en", "s1"), (304, say(english, 40) + " token = abcdef123456", "en", "s1")]
    folder = tmp_path_factory.mktemp("corpus")
    frame = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    frame.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), {r[0]: r[1] for r in rows}, toxic


def test_decisions_take_effect(spark, corpus):
    folder, texts, toxic = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        docs = cp.written(spark, stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == columns
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
        if k == 0:
            assert not toxic & seen[0].keys(), "toxic documents go"
            assert len(seen[0]) == len(texts) - len(toxic), "clean documents stay"
    assert seen[0].keys() - seen[1].keys() == {302, 303}
    assert seen[1].keys() - seen[2].keys() == {300, 301}, "one of each group stays"
    assert seen[3][304].endswith("[secret]")
    assert {k: t for k, t in seen[3].items() if k != 304} == {k: t for k, t in seen[2].items() if k != 304}
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    pieces = cp.STAGES[-1][1](spark, docs, folder).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(p["length"] for p in pieces) == sum(len(t.encode(x, add_special_tokens=False).ids) + 1 for x in seen[3].values())
    assert all(len(p["ids"]) == p["length"] for p in pieces)
    whole = cp.run(spark, folder)
    assert sorted((p["doc_id"], p["start"], p["ids_crc32"]) for p in whole.collect()) != []
    assert {p["doc_id"] for p in whole.collect()} == seen[3].keys()


def test_rows_that_repeat_stay_once(spark, docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text, "en", "a")] * 4 + [(9, text, "en", "a"), (12, "another text of no group", "en", "b"), (12, "under one id", "en", "b"), (None, text, "en", "c"), (None, text, "en", "c")]
    got = cp.drop_near_copies(spark, docs(rows), "").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted([("5", text), ("12", "another text of no group"), ("12", "under one id"), ("None", text), ("None", text)])


def test_no_documents(spark, corpus, tmp_path):
    folder, *_ = corpus
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_on_the_smallest_tables(spark):
    assert cp.run(spark, DATA).count() > 0
