"""Toxicity and language identification: held-out accuracy, gradients, paths and odd rows."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid, queries, toxicity
from tessera.llm.wordscan import words

SF = "/root/testdata/sf0.01"
DATA = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_gradients(monkeypatch):
    gen = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.new_parameters(gen, 3).items()}
    x, mask = gen.normal(size=(5, toxicity.INPUTS, 4)), (np.arange(5)[:, None] < np.array([5, 2, 3, 1])).astype(float)
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])

    def loss(q):
        out = toxicity.forward(q, toxicity.of_inputs(q, q["x"]), mask)
        return ((np.logaddexp(0, out) - y * out) * weight).sum() / weight.sum()

    g = toxicity.backward(p, x, mask, y, weight)
    p["x"] = x
    for k in p:
        for at in [tuple(gen.integers(0, s) for s in p[k].shape) for _ in range(4)]:
            up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
            up[k][at] += 1e-3
            down[k][at] -= 1e-3
            assert abs((loss(up) - loss(down)) / 2e-3 - g[k][at]) < 2e-3, (k, at)


def test_windows_cover_every_word():
    counts = np.array([0, 1, 32, 33, 48, 49, 500])
    text, first, size = toxicity.windows(counts)
    starts = np.cumsum(counts) - counts
    for t, n in enumerate(counts):
        of = text == t
        seen = {int(w) for a, s in zip(first[of], size[of], strict=True) for w in range(a - starts[t], a - starts[t] + s)}
        assert seen == set(range(n))
        assert (size[of] <= toxicity.WINDOW).all()


def test_character_grams(strings):
    w = words(strings(["ab abcdef"]))
    assert w.length.tolist() == [2, 6]
    assert w.start.tolist() == [0, 3]
    grams = toxicity.grams(w)
    assert all(len(g) == 8 for g in grams)
    assert [g[2] == toxicity.grams(words(strings(["abcdef"])))[k][0] for k, g in enumerate(grams)] == [True] * len(toxicity.GRAMS)


def plain_score(model, text):
    """Word by word, window by window, number by number."""
    import math

    def mixed(bits, parts):
        h = 0
        for p in parts:
            h = ((h ^ p) * 0x9E3779B1) & 0xFFFFFFFF
            h ^= h >> 15
        return ((h * 0x85EBCA77) & 0xFFFFFFFF) >> (32 - bits)

    def row(table, b):
        at = table.held.tolist()
        return table.rows[at.index(b) + 1].tolist() if b in at else table.rows[0].tolist()

    found, word = [], ""
    for c in (text or "") + " ":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            found.append(word)
            word = ""
    vectors = []
    for w in found:
        codes = [ord(c) for c in w]
        h = sum(c * pow(0x5851F42D4C957F2D, i, 1 << 64) for i, c in enumerate(codes)) % (1 << 64)
        own = row(model.of_word, mixed(toxicity.BITS, [h >> 32, h & 0xFFFFFFFF]))
        padded = [0, *codes] + [0] * 6
        each = []
        for i in range(len(codes)):
            rows = [row(model.of_gram, mixed(toxicity.BITS, padded[i : i + n])) for n in toxicity.GRAMS]
            each.append([sum(x) for x in zip(*rows, strict=True)])
        vectors.append(own + [max(x) for x in zip(*each, strict=True)])
    p = {k: v.tolist() for k, v in model.parameters.items()}
    sig = lambda x: 1 / (1 + math.exp(-x))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    hidden, best, start = len(p["uf"][0]), 0.0, 0
    while found:
        part = vectors[start : start + toxicity.WINDOW]
        states = [[] for _ in part]
        for d in "fb":
            h = [0.0] * hidden
            for t in range(len(part)) if d == "f" else range(len(part) - 1, -1, -1):
                g = [dot(w, part[t]) + c[0] for w, c in zip(p[f"w{d}"], p[f"c{d}"], strict=True)]
                u = p[f"u{d}"]
                r = [sig(g[i] + dot(u[i], h)) for i in range(hidden)]
                z = [sig(g[hidden + i] + dot(u[hidden + i], h)) for i in range(hidden)]
                rh = [a * b for a, b in zip(r, h, strict=True)]
                new = [math.tanh(g[2 * hidden + i] + dot(u[2 * hidden + i], rh)) for i in range(hidden)]
                h = [a + k * (b - a) for a, b, k in zip(h, new, z, strict=True)]
                states[t] = states[t] + h
        e = [math.exp(dot(p["v"][0], [math.tanh(dot(a, s)) for a in p["a"]])) for s in states]
        pooled = [sum(k * s[i] for k, s in zip(e, states, strict=True)) / sum(e) for i in range(2 * hidden)]
        best = max(best, sig(dot(p["o"][0], pooled) + p["z"][0][0]))
        if start + toxicity.WINDOW >= len(found):
            break
        start += toxicity.STRIDE
    return best


def test_scores_equal_a_plain_scorer(strings, odd):
    gen = np.random.default_rng(2)
    texts = [t for _, t, *_ in odd if t is None or len(t) < 400] + ["vile words of a Vile kind, über alles " * 9, "plain and clean " * 30 + "vile"]
    w = words(strings(texts))
    held = np.unique(toxicity.word_buckets(toxicity.word_hashes(w))[::2])
    grams = np.unique(np.concatenate(toxicity.grams(w))[::2])
    table = lambda b: toxicity.Table(b, np.concatenate([np.zeros((1, toxicity.SIZE)), gen.normal(size=(len(b), toxicity.SIZE))]).astype(np.float32))
    model = toxicity.ToxicityModel(table(held), table(grams), toxicity.new_parameters(gen))
    assert model.score(strings(texts)) == pytest.approx([plain_score(model, t) for t in texts], abs=1e-4)


def test_long_labelled_texts_are_learned_from(spark, docs):
    """All toxic texts are long; one key is repeated."""
    say = lambda i, n: " ".join(f"plain{(i * 7 + k) % 50} word" for k in range(n))
    rows = [(i, say(i, 3000) + " you moronface " + say(i, 20), "en", "a") for i in range(12)] + [(100 + i, say(i, 40), "en", "a") for i in range(40)]
    labels = spark.createDataFrame([(r[0], 1, int(r[0] < 100)) for r in rows], "doc_id long, quality int, toxic int")
    frame = docs([*rows, *[rows[0]] * 3])
    got = toxicity.toxicity(spark, frame, labels, F.col("doc_id") % 2 == 0).collect()
    assert all(r["predicted"] == int(r["doc_id"] < 100) for r in got)
    assert {r["held_out"] for r in toxicity.toxicity(spark, docs([(None, "x", "en", "a")]), labels, F.col("doc_id") % 2 == 0).collect()} == {False}


@DATA
def test_toxicity_on_held_out_rows(spark):
    got = queries.op2_toxicity(spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    clear = rows[rows.toxic == 0]
    assert (clear.predicted == 0).mean() > 0.95
    order = rows.score.rank()
    positive = rows.toxic == 1
    auc = (order[positive].sum() - positive.sum() * (positive.sum() + 1) / 2) / (positive.sum() * (~positive).sum())
    assert auc > 0.85
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert set(got.columns) == {"doc_id", "held_out", "score", "predicted"}


def test_toxicity_of_odd_rows(spark, docs, odd):
    train = [(1000 + i, f"some plain words here {i} and more of them", "en", "a") for i in range(60)] + [(2000 + i, f"some plain words {i} you moronface and more", "en", "a") for i in range(60)]
    both = docs([*odd, *train, (7000, "plain words " * 4000 + "you moronface", "en", "a")])
    labels = spark.createDataFrame([(r[0], 1, int(r[0] >= 2000)) for r in train] + [(2, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(spark, both, labels, F.lit(True)).collect()}
    assert got[1]["score"] == got[2]["score"] == got[3]["score"] == got[10]["score"] == 0
    assert got[2005]["predicted"] == 1
    assert got[1005]["predicted"] == 0
    assert got[7000]["predicted"] == 1, "the end of a long text counts"
    assert got[4]["score"] == pytest.approx(got[8]["score"], abs=1e-5)
    kept = toxicity.drop_toxic(spark, both, labels, F.lit(True))
    assert kept.columns == both.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if not r["predicted"]}
    none = toxicity.toxicity(spark, docs(odd), labels.limit(0), F.lit(True)).collect()
    assert len(none) == len(odd)
    assert all(r["score"] == 0 for r in none)
    assert toxicity.toxicity(spark, docs([]), labels, F.lit(True)).collect() == []


# ---- languages


@DATA
def test_languages_of_held_out_rows(spark):
    got = queries.op4_language_id(spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out and lang is not null").toPandas()
    assert (rows.lang_pred == rows.lang).mean() > 0.97
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


LATIN = ["the quick brown fox jumps over the lazy dog and then this that which", "der schnelle braune fuchs springt über den faulen hund und dann dieser"]
CYRILLIC = "быстрая лиса прыгает через ленивую собаку и потом этот"


def test_spans_scripts_and_odd_rows(spark, docs, odd):
    train = [(1000 + i, LATIN[0], "en", "a") for i in range(20)] + [(2000 + i, LATIN[1], "de", "a") for i in range(20)] + [(3000 + i, CYRILLIC, "ru", "a") for i in range(20)]
    mixed = f"{LATIN[0]}. {LATIN[1]}! {CYRILLIC}"
    frame = docs([*odd, *train, (50, mixed, None, "a"), (51, "日本語の文章", None, "a"), (52, "der the der", None, "a")])
    learn = F.coalesce(F.col("doc_id") >= 1000, F.lit(False))
    rows = langid.language_spans(spark, frame, learn).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(odd) + 63
    for k in (1, 2, 3, 10):
        assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0)
    assert [s["lang"] for s in got[50]["spans"]] == ["en", "de", "ru"]
    assert [mixed[s["start"] : s["end"]] for s in got[50]["spans"]] == [*LATIN, CYRILLIC]
    assert got[11]["lang_pred"] == "ru"
    assert got[51]["lang_pred"] in ("en", "de", "ru")
    assert got[51]["score"] == 0
    assert not got[1005]["held_out"]
    kept = langid.drop_unidentified(spark, frame, learn)
    assert kept.columns == frame.columns
    assert {1005, 2005, 3005, 11} <= {r["doc_id"] for r in kept.collect()}
    assert not {1, 2, 3, 10, 50, 51} & {r["doc_id"] for r in kept.collect()}
    assert {r["lang_pred"] for r in langid.language_spans(spark, docs(odd), F.lit(False)).collect()} == {"und"}
    assert langid.language_spans(spark, docs([]), F.lit(True)).collect() == []


def test_one_text_of_very_many_words(spark, docs):
    """130,000 words, the last fifth in another language: spans cover the whole text."""
    train = [(1000 + i, LATIN[k], ("en", "de")[k], "a") for i in range(40) for k in (i % 2,)]
    text = f"{LATIN[0]} " * 8000 + f"{LATIN[1]} " * 2000
    frame = docs([*train, (50, text, None, "a")])
    got = next(r for r in langid.language_spans(spark, frame, F.col("doc_id") >= 1000).collect() if r["doc_id"] == 50)
    assert got["lang_pred"] == "en"
    assert [s["lang"] for s in got["spans"]] == ["en", "de"]
    assert got["spans"][1]["start"] == pytest.approx(len(LATIN[0] + " ") * 8000, abs=5)
    assert got["spans"][1]["end"] == len(text) - 1


def test_viterbi_equals_all_paths():
    gen = np.random.default_rng(4)
    counts = np.array([3, 0, 1, 5])
    scores = gen.normal(size=(9, 3)) * 3
    got = langid.viterbi(scores, counts, 2.0)
    at = 0
    for n in counts:
        part = scores[at : at + n]
        value = lambda path: sum(part[i, s] for i, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))  # noqa: B023, E731
        best = max((tuple(p) for p in np.ndindex(*[3] * n)), key=value, default=())
        assert value(tuple(got[at : at + n])) == pytest.approx(value(best))
        at += n
