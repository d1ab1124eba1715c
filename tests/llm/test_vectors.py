from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import neardup, permutation

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, copies int, v string"
ODD = [(900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [1.0, None, *[0.0] * 6], 1), (904, [NAN] + [1.0] * 7, 1), (905, [INF] + [1.0] * 7, 1), (906, [1.0] * 8, None), (907, [1.0] * 8, 1), (908, [2.0] * 8, 1), (909, [1.0] * 5, 1)]


@pytest.fixture(scope="module")
def rows():
    gen = np.random.default_rng(1)
    out = list(ODD)
    for label in (1, 2):
        for g in range(25):
            base = gen.normal(size=8)
            for _ in range(8):
                out.append((len(out) + label * 1000 + g, (base + gen.normal(size=8) * gen.choice([0.0, 0.05, 0.12, 0.3])).astype(np.float32).tolist(), label))
    out += [(5000 + i, out[20][1], out[20][2]) for i in range(30)]
    out += [(5000, out[300][1], out[300][2])]  # one id, two vectors
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def test_near_duplicates_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 16)  # several tiles a cell
    links = {i: 0 for i in range(len(rows))}
    parent = {r[0]: r[0] for r in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    vectors = [np.array(r[1], np.float64) if sound(r[1]) else None for r in rows]
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            x, y = vectors[i], vectors[j]
            if a[2] is not None and a[2] == b[2] and x is not None and y is not None and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[i] += 1
                links[j] += 1
                p, q = top(a[0]), top(b[0])
                parent[max(p, q)] = min(p, q)
    want = sorted((r[0], links[i], top(r[0]), r[0] == top(r[0])) for i, r in enumerate(rows))
    got = neardup.near_duplicates(spark, frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == want
    assert sum(links.values()) > 1000


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(spark, frame(spark, [])).collect() == []
    got = neardup.near_duplicates(spark, frame(spark, [(1, None, 1), (None, [1.0], 1), (3, [1.0], 1)])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 0, 1, True), (None, 1, None, False), (3, 1, 3, True)], key=str)


@pytest.mark.parametrize("same", [True, False])
def test_tile_comparison_keeps_all_pairs(same):
    gen = np.random.default_rng(3)
    x = gen.normal(size=(150, 24))
    x[75:] = x[:75] + gen.normal(size=(75, 24)) * gen.uniform(0, 0.4, (75, 1))
    y = x if same else x[::-1].copy()
    turn = np.linalg.qr(gen.normal(size=(24, 24)))[0]
    i, j = neardup.linked_pairs(x, y, turn, 0.95, same)
    u, v = x / np.linalg.norm(x, axis=1)[:, None], y / np.linalg.norm(y, axis=1)[:, None]
    want = np.argwhere(np.triu(u @ v.T >= 0.95, 1) if same else u @ v.T >= 0.95)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = [(-float(np.dot(np.array(v, np.float64), np.array(w, np.float64))), i) for i, w, *_ in rows if sound(w) and len(w) == len(v) and i != q]
        out[q] = sorted(scored)[:k]
    return out


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(permutation, "BLOCK", 700)
    monkeypatch.setattr(permutation, "QUERIES", 40)
    monkeypatch.setattr(permutation, "LEAST", 64)
    gen = np.random.default_rng(5)
    data = gen.normal(size=(2000, 32)).astype(np.float32)
    data[1000:1100] = data[7]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(data)] + [(i + 5000, *r) for i, *r in ODD]
    got = permutation.nearest(spark, frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    want = brute_nearest(rows, [(i, v) for i, v, *_ in rows if i % 20 == 0 and sound(v)], 20)
    held = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        held.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert held.keys() == {q for q, near in want.items() if near}
    hits = sum(len({i for _, i in held[q]} & {i for _, i in near}) for q, near in want.items() if near)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q, near in held.items():
        assert near == sorted(near), "nearest first, ties to the smaller id"
        v = dict((i, v) for i, v, *_ in rows)
        assert np.allclose([-s for s, _ in near], [np.dot(np.array(v[q], np.float64), np.array(v[i], np.float64)) for _, i in near], rtol=1e-12)


def test_recall_of_uneven_norms_and_of_a_crowd(spark, monkeypatch):
    """Norms of a lognormal distribution, and (other lengths) a third of near copies and a third of exact ones; rows that don't ask are null."""
    monkeypatch.setattr(permutation, "LEAST", 32)
    gen = np.random.default_rng(6)
    uneven = gen.normal(size=(2400, 32))
    uneven *= np.exp(gen.normal(size=(2400, 1)))
    crowd = gen.normal(size=(2400, 24))
    crowd[800:1600] = crowd[0] + gen.normal(size=(800, 24)) * 0.05
    crowd[1600:] = crowd[1]
    rows = [(i, v.tolist(), 1) for i, v in enumerate([*uneven.astype(np.float32), *crowd.astype(np.float32)])]
    got = permutation.nearest(spark, frame(spark, rows), F.when(F.col("vec_id") % 20 == 0, F.lit(True))).collect()
    held = {}
    for r in got:
        held.setdefault(r["query_id"], set()).add(r["vec_id"])
    for data, first in ((uneven, 0), (crowd, 2400)):
        x = data.astype(np.float32).astype(np.float64)
        hits = []
        for q in range(0, 2400, 20):
            score = (x * x[q]).sum(1)
            score[q] = -np.inf
            hits.append(len(held[first + q] & {first + int(i) for i in np.lexsort((np.arange(2400), -score))[:20]}))
        assert sum(hits) >= 0.9 * 20 * len(hits)


def test_what_shared_pivots_stand_for():
    gen = np.random.default_rng(7)
    pivots = gen.normal(size=(200, 16))
    start, slope, deviation = permutation.cosine_of_shared(pivots, 50)
    assert slope > 0
    assert 0 < deviation < 0.2
    assert permutation.cosine_of_shared(pivots[:5], 50)[2] == np.inf
    assert permutation.foremost(np.array([3, 1, 3, 2, 3]), 2).tolist() == [0, 2]


def test_few_candidates(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (2, [0.5, 0.0], 1), (20, [0.0, 0.0], 1), (40, [1.0], 1), (None, [9.0, 9.0], 1)]
    got = permutation.nearest(spark, frame(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert permutation.nearest(spark, frame(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def test_footrule_from_inverted_files():
    gen = np.random.default_rng(2)
    order = np.array([gen.permutation(12)[:5] for _ in range(40)])
    place = np.full((40, 12), 5)
    np.put_along_axis(place, order, np.arange(5)[None].repeat(40, 0), 1)
    files = permutation.InvertedFiles(order, 12)
    for q in range(10):
        foot = np.abs(place - place[q]).sum(1)
        assert sorted(files.nearest(order[q], 7).tolist()) == sorted(np.lexsort((np.arange(40), foot))[:7].tolist())
