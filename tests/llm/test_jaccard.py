from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import jaccard, shingles
from tessera.llm.common import components


def plain_set(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, size=4, num=85, den=100):
    sets = [(k, plain_set(t, size)) for k, t in rows]
    parent = {k: k for k, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and None not in (a, b) and den * len(x & y) >= num * len(x | y):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((k, len(s), None if k is None else top(k)) for k, s in sets), key=str)


def family(rng, n, base, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("size", "num"), [(4, 85), (5, 80)])
def test_classes_equal_brute_force(spark, docs, odd, size, num):
    rng = random.Random(size)
    texts = []
    for n in (3, 7, 12, 40, 150, 400):
        texts += family(rng, 12, [f"v{rng.randrange(3000)}" for _ in range(n)], 1 + n // 25)
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(n)) for n in (1, 2, 4, 8, 60, 60, 60)]
    texts += [texts[0]] * 5 + [passage]
    rows = [*[(50 + i, t, "en", "a") for i, t in enumerate(texts)], *odd, (6, "another text under the same key as the long one", "en", "b")]
    got = jaccard.jaccard_classes(spark, docs(rows), size=size, scheme=jaccard.PartEnum(num=num))
    want = brute([(k, t) for k, t, *_ in rows], size, num)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert len({c for *_, c in want}) < len(want) - 30


def test_no_documents(spark, docs):
    assert jaccard.jaccard_classes(spark, docs([])).collect() == []
    assert [tuple(r) for r in jaccard.jaccard_classes(spark, docs([(1, None, "en", "a"), (2, " ", "en", "a")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 900), st.randoms(use_true_random=False), st.sampled_from([(85, 2, 1), (80, 2, 1), (85, 3, 1), (80, 3, 2), (90, 4, 2)]), st.sampled_from([0, 0.5, 1]))
def test_linked_sets_share_a_signature_that_neither_leaves_out(n, rng, scheme, crowded):
    num, n2, k2 = scheme
    plan = jaccard.PartEnum(num=num, n2=n2, k2=k2)
    gen = np.random.default_rng(rng.randrange(10**9))
    a = np.unique(gen.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    drop = rng.randrange(0, n // 4 + 1)
    b = np.unique(np.concatenate([a[gen.permutation(len(a))[drop:]], gen.integers(0, 1 << 63, rng.randrange(0, n // 8 + 1), dtype=np.uint64)]))
    if not len(b):
        return
    both = len(np.intersect1d(a, b))
    sig, of, band, left = jaccard.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), plan)
    size = {s: rng.randrange(100) if rng.random() < crowded else 2 for s in np.unique(sig).tolist()}
    kept = []
    for side in (0, 1):
        held = set()
        for w in np.unique(band[of == side]):
            own = (of == side) & (band == w)
            order = sorted(sig[own].tolist(), key=lambda s: (size[s], s))
            held |= set(order[: len(order) - int(left[own][0])])
        kept.append(held)
    if 100 * both >= num * (len(a) + len(b) - both) and not (len(a) == len(b) == both):
        assert kept[0] & kept[1]
    bits = jaccard.parities(np.concatenate([a, b]), np.array([len(a), len(b)]))
    assert sum(int(x).bit_count() for x in (bits[0] ^ bits[1]).view(np.uint64)) <= len(a) + len(b) - 2 * both


def test_a_large_family_without_links(spark, docs):
    """2,000 texts of one template, no two of which link, but for one near copy of each of three."""
    rng = random.Random(11)
    base = [f"v{i}" for i in range(60)]
    texts = []
    for i in range(2000):
        words = list(base)
        for at in range(rng.randrange(4), 60, 8):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    texts += [" ".join(t.split()[:-1]) for t in texts[:3]]
    got = jaccard.jaccard_classes(spark, docs([(i, t, "en", "a") for i, t in enumerate(texts)]))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {**{i: i for i in range(2000)}, 2000: 0, 2001: 1, 2002: 2}


def test_a_key_with_several_texts_links_by_each(spark, docs):
    a, b = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = [(3, a), (5, a), (5, b), (9, b + " more"), (11, b + " " + " ".join(f"c{i}" for i in range(40)))]
    got = jaccard.jaccard_classes(spark, docs([(k, t, "en", "s") for k, t in rows]))
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == [(3, 3), (5, 3), (5, 3), (9, 3), (11, 11)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbé \t\n\x0b\x1c日"), max_size=30), max_size=6), st.integers(1, 5))
def test_shingle_sets(strings, texts, size):
    hashes, sizes = shingles.sets(strings(texts), size)
    ends = np.cumsum(sizes)
    sets = [frozenset(hashes[e - n : e].tolist()) for e, n in zip(ends, sizes, strict=True)]
    plain = [plain_set(t, size) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for x, p in zip(sets, plain, strict=True):
        for y, q in zip(sets, plain, strict=True):
            assert len(x & y) == len(p & q)


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = spark.createDataFrame([*chain, (1, 2), (3, 2), (5, 5), (7, 8), (8, 7), (None, 4)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(spark, edges).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), 1: 1, 2: 1, 3: 1, 7: 7, 8: 7}
    assert components(spark, edges.limit(0)).collect() == []
