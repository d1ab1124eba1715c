"""Toxicity scores: a bidirectional gated recurrent network with attention pooling, over all windows of a text.

Every word is a position. Its input is a learned vector of the word next to the largest values (by number) of the
learned vectors of its character n-grams (3 and 5 letters, with word borders); both are trained with the network. A gated
recurrent layer reads each window in both directions, attention weighs the positions, and a logistic output
scores the window. A text's score is the largest of all its overlapping windows, so whole texts count and a short
outburst in a long text isn't diluted.

Training takes a sample of labelled rows (``TOXIC`` and ``CLEAN`` of them at most, about, by a hash of the key; one
row a key), whole texts whatever their length. Spark counts in how many of them each word and n-gram occurs, by
label; those in ``SEEN`` texts or more have vectors, which start from their log odds, all others share zero. Then
Spark cuts the texts into windows and keeps of each the ``TOP`` with most evidence (of clean ones ``OTHERS`` besides),
so what reaches the driver is bounded by the number of rows. There, in numpy, the window of each toxic text that
scores highest so far is a positive, chosen anew in every round, and windows of clean texts are negatives. Words and
n-grams are left out at random, so neither table learns to do without the other.

Defined cases: null texts and texts without a letter score 0; without labelled rows of both kinds every text
scores 0; repeated rows are scored alike; a row without a key is neither learned from nor held out; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, pieces_of, spread, written
from tessera.llm.wordscan import Words, bucket, words

#: Bounds of the training sample.
TOXIC, CLEAN = 3000, 6000
#: Windows with most evidence that are kept of a training text, others of a clean one; texts that must hold a bucket.
TOP, OTHERS, SEEN = 3, 4, 3
#: Share of the toxic texts that must hold a bucket for half of its log odds to count.
PRIOR = 0.1
#: Words of a window, words from one window to the next, hidden units of a direction, numbers of a vector.
WINDOW, STRIDE, HIDDEN, SIZE = 32, 16, 6, 6
#: Bits of a hashed word or n-gram; letters of n-grams.
BITS, GRAMS = 20, (3, 5)
INPUTS = 2 * SIZE
#: Windows in a training step, steps of a round, rounds, share of words and n-grams left out.
BATCH, STEPS, ROUNDS, LEFT_OUT = 128, 60, 6, 0.25
#: Step sizes of the network and of the tables, and what positives weigh against negatives.
RATE, TABLE_RATE, POSITIVE = 0.01, 0.00005, 0.4
#: Share of toxic texts with the least evidence that a round leaves out: labels are noisy.
TRIM = 0.05
THRESHOLD = 0.7


def grams(w: Words) -> list[np.ndarray]:
    """For each n: the bucket of the n-gram that begins one before each letter, within its word and its borders."""
    parts, reach, out = [w.before, w.low], w.low, []
    for n in range(3, max(GRAMS) + 1):
        k = n - 3
        reach = np.where(reach > 0, np.concatenate([w.after[k:], np.zeros(min(k, len(w.low)), w.after.dtype)]), 0)
        parts.append(reach)
        if n in GRAMS:
            out.append(bucket(BITS, *parts))
    return out


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit polynomial of each word's letters."""
    if not len(w.first):
        return np.zeros(0, np.uint64)
    place = np.arange(len(w.low)) - np.repeat(w.first, w.length)
    powers = np.full(int(w.length.max()), 0x5851F42D4C957F2D, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    return np.add.reduceat(w.low.astype(np.uint64) * powers[place], w.first)


def word_buckets(hashes: np.ndarray) -> np.ndarray:
    return bucket(BITS, (hashes >> np.uint64(32)).astype(np.uint32), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32))


def only(w: Words, which: np.ndarray) -> Words:
    """Some of the words, as those of one text."""
    length = w.length[which]
    at = spread(w.first[which], length)
    first = np.cumsum(length) - length
    return Words(w.low[at], w.before[at], w.after[at], first, length, np.zeros(len(which), np.int64), np.array([len(which)]))


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Shrunken log odds: near 0 where a bucket is rare, measured by the number of toxic texts (words that only a
    family of copies holds tell little)."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    seen = toxic + clean
    return (np.clip(odds, -2, 4) * seen / (seen + max(2, PRIOR * n_toxic))).astype(np.float32)


def windows(counts: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of every window: at each stride, up to the one that holds the text's end."""
    n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - window) // stride)), 0)
    text = np.repeat(np.arange(len(counts)), n)
    inner = spread(np.zeros(len(n), np.int64), n) * stride
    return text, np.repeat(np.cumsum(counts) - counts, n) + inner, np.minimum(window, np.repeat(counts, n) - inner)


def gather(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps, windows): the place of each word, and whether there is one."""
    steps = np.arange(int(size.max()) if len(size) else 0)[:, None]
    mask = steps < size[None, :]
    return np.where(mask, first[None, :] + steps, 0), mask.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def new_parameters(rng: np.random.Generator, hidden: int = HIDDEN, inputs: int = INPUTS) -> dict[str, np.ndarray]:
    p = {}
    for d in "fb":
        p[f"w{d}"] = rng.normal(0, 0.4, (3 * hidden, inputs))
        p[f"u{d}"] = rng.normal(0, 0.3, (3 * hidden, hidden))
        p[f"c{d}"] = np.zeros((3 * hidden, 1))
    p |= {"a": rng.normal(0, 0.4, (hidden, 2 * hidden)), "v": rng.normal(0, 0.4, (1, hidden)), "o": rng.normal(0, 0.4, (1, 2 * hidden)), "z": np.zeros((1, 1))}
    return {k: x.astype(np.float32) for k, x in p.items()}


def forward(p: dict[str, np.ndarray], gate, mask: np.ndarray, keep: bool = False):
    """Scores before the logistic of windows; ``gate(d, t)`` gives what the input adds to the gates of direction
    ``d`` at step ``t`` (3 hidden, windows), and ``mask`` (steps, windows) marks words."""
    steps, n = mask.shape
    hidden = p["uf"].shape[1]
    states = np.zeros((steps, 2 * hidden, n), np.float32)
    held = {"f": [], "b": []}
    for k, d in enumerate("fb"):
        h = np.zeros((hidden, n), np.float32)
        u = p[f"u{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = gate(d, t)
            rz = _sigmoid(g[: 2 * hidden] + u[: 2 * hidden] @ h)
            r, z = rz[:hidden], rz[hidden:]
            new = np.tanh(g[2 * hidden :] + u[2 * hidden :] @ (r * h))
            z = z * mask[t]  # no word, no change
            if keep:
                held[d].append((t, h, r, z, new, rz[hidden:]))
            h = h + z * (new - h)
            states[t, k * hidden : (k + 1) * hidden] = h
    inner = np.tanh(np.matmul(p["a"], states))
    e = np.matmul(p["v"], inner)[:, 0, :] + (mask - 1) * np.float32(1e4)
    e = np.exp(e - e.max(0))
    e /= e.sum(0)
    pooled = (states * e[:, None, :]).sum(0)
    out = (p["o"] @ pooled + p["z"])[0]
    return (out, states, held, inner, e, pooled) if keep else out


def of_inputs(p: dict[str, np.ndarray], x: np.ndarray):
    """``gate`` for inputs (steps, inputs, windows)."""
    return lambda d, t: p[f"w{d}"] @ x[t] + p[f"c{d}"]


def backward(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted mean logistic loss, by the parameters and (``x``) by the inputs."""
    out, states, held, inner, e, pooled = forward(p, of_inputs(p, x), mask, True)
    hidden = p["uf"].shape[1]
    g = {k: np.zeros_like(v) for k, v in p.items()} | {"x": np.zeros_like(x)}
    d_out = ((_sigmoid(out) - y) * weight / weight.sum())[None, :].astype(np.float32)
    g["o"], g["z"] = d_out @ pooled.T, d_out.sum(1, keepdims=True)
    d_pool = p["o"].T @ d_out
    d_states = e[:, None, :] * d_pool[None]
    d_e = (states * d_pool[None]).sum(1)
    d_e = e * (d_e - (e * d_e).sum(0))
    d_inner = p["v"].T[None] * d_e[:, None, :] * (1 - inner * inner)
    g["v"] = np.einsum("tn,thn->h", d_e, inner)[None]
    g["a"] = np.einsum("tin,tjn->ij", d_inner, states)
    d_states += np.matmul(p["a"].T, d_inner)
    for k, d in enumerate("fb"):
        u = p[f"u{d}"]
        dh = np.zeros((hidden, x.shape[2]), np.float32)
        for t, h, r, z, new, gate in reversed(held[d]):
            dh = dh + d_states[t, k * hidden : (k + 1) * hidden]
            d_new = dh * z * (1 - new * new)
            d_z = dh * (new - h) * mask[t] * gate * (1 - gate)
            back = u[2 * hidden :].T @ d_new
            d_r = back * h * r * (1 - r)
            both = np.concatenate([d_r, d_z])
            full = np.concatenate([both, d_new])
            g[f"w{d}"] += full @ x[t].T
            g[f"c{d}"] += full.sum(1, keepdims=True)
            g[f"u{d}"][: 2 * hidden] += both @ h.T
            g[f"u{d}"][2 * hidden :] += d_new @ (r * h).T
            g["x"][t] += p[f"w{d}"].T @ full
            dh = dh * (1 - z) + back * r + u[: 2 * hidden].T @ both
    return g


@dataclass
class Table:
    """Vectors of the buckets that have one; row 0, for all others, is zero."""

    held: np.ndarray  #: buckets with a vector, ascending; the first of them has row 1
    rows: np.ndarray  #: (1 + held, SIZE)

    def places(self, buckets: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.held, buckets)
        known = np.append(self.held, -1)[at] == buckets
        return np.where(known, at + 1, 0)


@dataclass
class ToxicityModel:
    of_word: Table | None
    of_gram: Table | None
    parameters: dict[str, np.ndarray] | None

    def inputs(self, w: Words, hashes: np.ndarray) -> np.ndarray:
        """(words, INPUTS): the word's vector and the largest of its n-grams', those of one letter added up."""
        by_letter = sum(self.of_gram.rows[self.of_gram.places(g)] for g in grams(w))
        most = np.maximum.reduceat(by_letter, w.first, axis=0)
        return np.concatenate([self.of_word.rows[self.of_word.places(word_buckets(hashes))], most], 1).astype(np.float32)

    def score(self, array: pa.Array) -> np.ndarray:
        """Each text's largest window score. Equal words of a batch are looked up once."""
        w = words(array)
        out = np.zeros(len(w.counts))
        if self.parameters is None or not len(w.first):
            return out
        hashes, which, place = np.unique(word_hashes(w), return_index=True, return_inverse=True)
        x = self.inputs(only(w, which), hashes).T
        gates = {d: self.parameters[f"w{d}"] @ x + self.parameters[f"c{d}"] for d in "fb"}
        text, first, size = windows(w.counts)
        for a in range(0, len(text), 4096):
            part = slice(a, a + 4096)
            at, mask = gather(first[part], size[part])
            at = place[at]
            np.maximum.at(out, text[part], _sigmoid(forward(self.parameters, lambda d, t: gates[d].take(at[t], 1), mask)).astype(np.float64))  # noqa: B023
        return out


def distinct_words(texts: list[str], size: int = 2048) -> tuple[np.ndarray, np.ndarray, Words]:
    """(number of each word among the distinct ones, words of each text, the distinct words), a few texts at a time."""
    hashes, counts, seen, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], np.zeros(0, np.uint64), []
    for a in range(0, len(texts), size):
        w = words(pa.array(texts[a : a + size], pa.string()))
        own = word_hashes(w)
        found, which = np.unique(own, return_index=True)
        new = ~np.isin(found, seen)
        held.append((found[new], only(w, which[new])))
        seen = np.union1d(seen, found[new])
        hashes.append(own)
        counts.append(w.counts)
    names = np.concatenate([h for h, _ in held]) if held else seen
    together = lambda f: np.concatenate([f(k) for _, k in held]) if held else np.zeros(0, np.int64)
    length = together(lambda k: k.length)
    all_new = Words(together(lambda k: k.low), together(lambda k: k.before), together(lambda k: k.after), np.cumsum(length) - length, length, np.zeros(len(length), np.int64), np.array([len(length)]))
    return np.searchsorted(seen, np.concatenate(hashes)), np.concatenate(counts), only(all_new, np.argsort(names))


def fit(texts: list[str], of: np.ndarray, toxic: np.ndarray, of_word: Table, of_gram: Table, seed: int = 5) -> ToxicityModel:
    """Train on windows (``of``: the number of each window's text; 1 toxic); the tables' rows are trained as well."""
    if not (toxic == 1).any() or not (toxic == 0).any():
        return ToxicityModel(None, None, None)
    rng = np.random.default_rng(seed)
    place, counts, kinds = distinct_words(texts)
    hashes = word_hashes(kinds)
    word_row = of_word.places(word_buckets(hashes))
    gram_row = np.stack([of_gram.places(g).astype(np.int32) for g in grams(kinds)])  # (n-gram sizes, letters)
    p = new_parameters(rng) | {"words": of_word.rows, "grams": of_gram.rows}
    model = ToxicityModel(Table(of_word.held, p["words"]), Table(of_gram.held, p["grams"]), p)
    first, length = np.cumsum(counts) - counts, np.minimum(counts, WINDOW)
    some = np.flatnonzero(length)
    first, length, label, of = first[some], length[some], toxic[some], of[some]
    vectors = lambda: np.concatenate([p["words"][word_row], np.maximum.reduceat(p["grams"][gram_row].sum(0), kinds.first, axis=0)], 1)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    x, step = vectors(), 0
    strength = np.array([2 * x[place[a : a + b]][:, [0, SIZE]].sum(1).max() - 3 for a, b in zip(first, length, strict=True)])
    clean = np.flatnonzero(label == 0)
    letters = np.repeat(np.arange(len(kinds.length)), kinds.length)
    for _ in range(ROUNDS):
        order = np.lexsort((-strength, of))
        top = order[np.append(True, of[order][1:] != of[order][:-1])]
        positive = top[label[top] == 1]
        positive = positive[np.argsort(-strength[positive], kind="stable")[: max(1, int(np.ceil((1 - TRIM) * len(positive))))]]
        hard = clean[np.argsort(-strength[clean], kind="stable")[: 2 * len(positive)]]
        chosen = np.concatenate([positive, hard, rng.choice(clean, min(len(clean), 3 * len(positive)), replace=False)])
        y = label[chosen].astype(np.float32)
        weight = np.where(y == 1, (y == 0).sum() / max(1, (y == 1).sum()) * POSITIVE, 1).astype(np.float32)
        for _ in range(max(2, -(-STEPS * BATCH // len(chosen)))):
            mixed = rng.permutation(len(chosen))
            for a in range(0, len(mixed), BATCH):
                part = mixed[a : a + BATCH]
                at, mask = gather(first[chosen[part]], length[chosen[part]])
                at = place[at]
                used, back = np.unique(at, return_inverse=True)
                back = back.reshape(at.shape)
                # this step's vectors of the words in it, with some left out
                in_step = np.isin(letters, used)
                rows, owner = gram_row[:, in_step], np.searchsorted(used, letters[in_step])
                stay_w, stay_g = (rng.random((len(used), 1)) >= LEFT_OUT for _ in range(2))
                by_letter = p["grams"][rows].sum(0)
                most = np.maximum.reduceat(by_letter, np.searchsorted(owner, np.arange(len(used))), axis=0)
                both = np.concatenate([p["words"][word_row[used]] * stay_w, most * stay_g], 1).astype(np.float32)
                g = backward(p, np.ascontiguousarray(both[back].transpose(0, 2, 1)), mask, y[part], weight[part])
                by_word = np.zeros_like(both)
                np.add.at(by_word, back.reshape(-1), (g.pop("x") * mask[:, None, :]).transpose(0, 2, 1).reshape(-1, INPUTS))
                np.add.at(g["words"], word_row[used], by_word[:, :SIZE] * stay_w)
                each = (by_word[:, SIZE:] * stay_g)[owner] * (by_letter == most[owner])
                for r in rows:
                    np.add.at(g["grams"], r, each)
                g["words"][0] = g["grams"][0] = 0
                step += 1
                for k in p:  # Adam
                    m, v = moment[k]
                    m += 0.1 * (g[k] - m)
                    v += 0.001 * (g[k] * g[k] - v)
                    p[k] -= np.float32(TABLE_RATE if k in ("words", "grams") else RATE) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        x = np.ascontiguousarray(vectors().T)
        gates = {d: p[f"w{d}"] @ x + p[f"c{d}"] for d in "fb"}
        for a in range(0, len(first), 4096):
            at, mask = gather(first[a : a + 4096], length[a : a + 4096])
            at = place[at]
            strength[a : a + 4096] = forward(p, lambda d, t: gates[d].take(at[t], 1), mask)  # noqa: B023
    model.parameters = {k: v for k, v in p.items() if k not in ("words", "grams")}
    return model


# ---------------------------------------------------------------- the training sample, by Spark


def sample(docs: DataFrame, labels: DataFrame, learn: Column, key: str, text: str, label: str) -> DataFrame | None:
    """Rows (doc, text, toxic), one a key, at most about ``TOXIC`` and ``CLEAN`` of them; None without both kinds."""
    marked = labels.where(learn & F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("key_")).agg(F.max(label).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    share = {y: min(1.0, most / counts[y]) for y, most in ((1, TOXIC), (0, CLEAN))}
    place = F.pmod(F.xxhash64(F.lit(3), "key_"), F.lit(1 << 20))
    chosen = marked.where(place < F.when(F.col("toxic") == 1, int(share[1] * (1 << 20))).otherwise(int(share[0] * (1 << 20))))
    joined = docs.where(F.col(text).isNotNull()).join(F.broadcast(chosen), F.col(key) == F.col("key_"))  # as many rows as the bounds
    return joined.groupBy(F.xxhash64("key_").alias("doc"), "toxic").agg(F.min_by(F.col(text), F.xxhash64(text)).alias("text"))


def count_buckets(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind and bucket, toxic texts, clean texts) of the buckets that ``SEEN`` texts hold; n-grams lie beyond words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2 << BITS), np.int32)
        for whole in batches:
            for batch in pieces_of(whole, "text"):
                w, toxic = words(batch.column(1)), batch.column(2).to_numpy()
                of_word = np.repeat(np.arange(len(w.counts)), w.counts)
                of_letter = np.repeat(of_word, w.length)
                both = [of_word * (2 << BITS) + word_buckets(word_hashes(w)), *(of_letter * (2 << BITS) + (1 << BITS) + g for g in grams(w))]
                once = np.unique(np.concatenate(both))
                np.add.at(total, (toxic[once >> (BITS + 1)], once & ((2 << BITS) - 1)), 1)
        at = np.flatnonzero(total.sum(0))
        for a in range(0, len(at), 1 << 16):
            part = at[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[1, part]), pa.array(total[0, part])], ["at", "toxic", "clean"])

    sums = rows.select("doc", "text", "toxic").mapInArrow(counted, "at long, toxic int, clean int").groupBy("at").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = sums.where(F.col("toxic") + F.col("clean") >= SEEN).toArrow().sort_by("at")  # fewer than buckets
    return tuple(found[c].to_numpy() for c in ("at", "toxic", "clean"))


def cut_windows(rows: DataFrame, held: np.ndarray, weight: np.ndarray) -> pa.Table:
    """(doc, toxic, text) of the windows of each text with most evidence, and of others at even distance in that order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell = lambda b: np.where(np.append(held, -1)[at := np.searchsorted(held, b)] == b, np.append(weight, 0)[at], 0)
        for whole in batches:
            for batch in pieces_of(whole, "text"):
                w = words(batch.column(1))
                if not len(w.first):
                    continue
                by_gram = np.maximum.reduceat(sum(tell(g + (1 << BITS)) for g in grams(w)) / len(GRAMS), w.first)
                each = tell(word_buckets(word_hashes(w))) + by_gram
                text, first, size = windows(w.counts)
                at, mask = gather(first, size)
                strength = (each[at] * mask).max(0)
                order = np.lexsort((-strength, text))
                rank = np.arange(len(order)) - np.searchsorted(text[order], text[order], "left")
                step = np.maximum(1, (np.bincount(text, minlength=len(w.counts)) - TOP) // OTHERS)[text[order]]
                doc = batch.column(0).to_numpy()
                more = batch.column(2).to_numpy()[text[order]] == 0
                keep = (rank < TOP) | more & ((rank - TOP) % step == 0) & ((rank - TOP) // step < OTHERS)
                chosen = order[keep]
                strings = batch.column(1).to_pylist()
                starts, ends = w.start[first[chosen]], w.end[first[chosen] + size[chosen] - 1]
                out = [strings[t][a:b] for t, a, b in zip(text[chosen].tolist(), starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc[text[chosen]]), batch.column(2).take(pa.array(text[chosen])), pa.array(out, pa.string())], ["doc", "toxic", "text"])

    found = rows.select("doc", "text", "toxic").mapInArrow(cut, "doc long, toxic int, text string").toArrow()  # TOP + OTHERS windows a row of the sample at most
    return found.sort_by([("doc", "ascending"), ("text", "ascending")])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fit on a bounded sample of the labelled rows that ``learn`` (over the key) marks."""
    rows = sample(docs, labels, learn, key, text, label)
    if rows is None:
        return ToxicityModel(None, None, None)
    rows = written(spark, rows, "labelled")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return ToxicityModel(None, None, None)
    held, toxic, clean = count_buckets(rows)
    weight = evidence(toxic.astype(float), clean.astype(float), n[1], n[0])
    found = cut_windows(rows, held, weight)
    rng = np.random.default_rng(1)
    tables = []
    for kind in (0, 1):
        own = (held >> BITS) == kind
        start = rng.normal(0, 0.1, (1 + int(own.sum()), SIZE)).astype(np.float32)
        start[1:, 0] = weight[own]
        start[0] = 0
        tables.append(Table(held[own] - (kind << BITS), start))
    _, of = np.unique(found["doc"].to_numpy(), return_inverse=True)
    return fit(found["text"].to_pylist(), of, found["toxic"].to_numpy(), *tables)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", model: ToxicityModel | None = None) -> DataFrame:
    """Rows (key, held_out, score, predicted), one per row of ``docs``."""
    bounded_batches(spark)
    model = model or train(spark, docs, labels, learn, key, text, label)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "text_"):
                score = model.score(batch.column(2))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["key", "held_out", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(~learn, F.lit(False)).alias("held_out"), F.col(text).alias("text_"))
    return rows.mapInArrow(scored, f"key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("key", key)


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``; no shuffle."""
    bounded_batches(spark)
    model = train(spark, docs, labels, learn, key, text, label)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, text):
                yield batch.filter(pa.array(model.score(batch.column(batch.schema.get_field_index(text))) < threshold))

    return docs.mapInArrow(clean, docs.schema)
