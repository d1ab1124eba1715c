"""Language identification with spans: script ranges, per-word scores and Viterbi with a switching penalty.

Letters' scripts (fixed code point ranges) narrow the languages that a word may have to those that write in it.
A word's score for each such language adds log probabilities of its letter trigrams, learned from labelled
texts. Over each text's words the best path through the languages is found with a penalty for every switch, so
runs of one language come out as spans, and stray words don't break them.

Training takes about ``PER_LANGUAGE`` labelled texts of each language, the rows that ``learn`` marks; counts are
added up by Spark into a table of fixed size.

Defined cases: null texts and texts without a letter are ``und`` with score 0; a text in a script that no
language writes gets the most frequent language with a score of 0; without labelled rows all is ``und``; repeated
rows are judged alike; a row without a key is neither learned from nor held out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, pieces_of
from tessera.llm.wordscan import Words, bucket, words

#: Training texts of a language (about), bits of the trigram table, penalty of a switch in nats.
PER_LANGUAGE, BITS, SWITCH = 2000, 15, 12.0
#: A language writes in the scripts that hold this share of its training letters.
WRITES = 0.01
UNKNOWN = "und"

#: First code points of script ranges (Unicode blocks) and the scripts.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "hiragana"), (0x30A0, "katakana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"),
    (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"),
    (0xFF21, "latin"), (0xFF66, "katakana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32400, "other"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS])


def script_of(points: np.ndarray) -> np.ndarray:
    return _SCRIPT[np.searchsorted(_STARTS, points, "right") - 1]


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  #: (buckets, languages) log probabilities, centred
    writes: np.ndarray  #: (scripts, languages) may a word in this script be in this language?
    default: int  #: the most frequent language


def trigrams(w: Words) -> np.ndarray:
    return bucket(BITS, w.before, w.low, w.after)


def train(docs: DataFrame, text: str, lang: str, learn: Column, per_language: int = PER_LANGUAGE) -> LanguageModel:
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text_"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    languages = sorted(counts)
    sample = rows.sampleBy("lang", {k: min(1.0, per_language / n) for k, n in counts.items()}, seed=11) if languages else rows

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, scripts = np.zeros((len(languages), 1 << BITS), np.int64), np.zeros((len(languages), len(_NAMES)), np.int64)
        for whole in batches:
            for batch in pieces_of(whole, "text_"):
                w = words(batch.column(1))
                of = np.array([languages.index(x) for x in batch.column(0).to_pylist()])
                per_letter = np.repeat(np.repeat(of, w.counts), w.length)
                table += np.bincount(per_letter * (1 << BITS) + trigrams(w), minlength=table.size).reshape(table.shape)
                scripts += np.bincount(per_letter * len(_NAMES) + script_of(w.low), minlength=scripts.size).reshape(scripts.shape)
        flat = np.concatenate([table, scripts], axis=1)
        of, at = np.nonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(at), pa.array(flat[of, at])], ["of", "at", "n"])

    flat = np.zeros((len(languages), (1 << BITS) + len(_NAMES)))
    if languages:  # at most one row a language and bucket, in Arrow batches
        sums = sample.mapInArrow(counted, "of long, at long, n long").groupBy("of", "at").agg(F.sum("n").alias("n")).toArrow()
        flat[sums["of"].to_numpy(), sums["at"].to_numpy()] = sums["n"].to_numpy()
    grams, scripts = flat[:, : 1 << BITS] + 0.2, flat[:, 1 << BITS :]
    logs = np.log(grams / grams.sum(1, keepdims=True)).T if languages else np.zeros((1 << BITS, 0))
    writes = (scripts >= WRITES * scripts.sum(1, keepdims=True)) & (scripts > 0)
    return LanguageModel(languages, (logs - logs.mean(1, keepdims=True) if languages else logs).astype(np.float32), writes.T, max(range(len(languages)), key=lambda i: counts[languages[i]], default=0))


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word, text by text; all texts of a batch take each step together."""
    label = np.zeros(len(scores), np.int64)
    if not len(scores):
        return label
    order = np.argsort(-counts, kind="stable")
    sizes, starts = counts[order], (np.cumsum(counts) - counts)[order]
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")  # texts longer than each step
    best, from_, switched = scores[starts[: active[0]]].copy(), np.zeros(len(scores), np.int8), np.zeros(scores.shape, bool)
    last = np.zeros(len(sizes), np.int64)
    for t in range(1, len(active)):
        n = active[t]
        if n < len(best):
            last[n : len(best)] = best[n:].argmax(1)
            best = best[:n]
        at = starts[:n] + t
        top = best.argmax(1)
        other = best[np.arange(n), top][:, None] - penalty
        switched[at] = best < other
        from_[at] = top
        best = np.maximum(best, other) + scores[at]
    last[: len(best)] = best.argmax(1)
    state = last
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        label[at] = state[:n]
        state[:n] = np.where(switched[at, state[:n]], from_[at], state[:n])
    return label


def identify(model: LanguageModel, w: Words, penalty: float = SWITCH) -> tuple[np.ndarray, np.ndarray]:
    """(language of each word or -1, its letters' evidence): script candidates, scores, path."""
    n = len(w.first)
    if not n or not model.languages:
        return np.full(n, -1), np.zeros(n, bool)
    scores = np.add.reduceat(model.weights[trigrams(w)], w.first)
    may = model.writes[script_of(w.low[w.first])]
    known = may.any(1)
    scores[known[:, None] & ~may] = -1e6
    scores[~known] = 0
    return viterbi(scores, w.counts, penalty), known


def predict(model: LanguageModel, array: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(language, score, spans) of each text."""
    names, size, n = np.array([*model.languages, UNKNOWN], object), len(model.languages), len(array)
    w = words(array)
    label, known = identify(model, w)
    doc = np.repeat(np.arange(n), w.counts)
    pred, score, cut = np.full(n, size), np.zeros(n), np.zeros(0, np.int64)
    if size and len(doc):
        held = np.bincount(doc * size + label, weights=w.length * known, minlength=n * size).reshape(-1, size)
        letters = np.bincount(doc, weights=w.length, minlength=n)
        some = letters > 0
        pred[some] = np.where(held[some].sum(1) > 0, held[some].argmax(1), model.default)
        score[some] = held[some].max(1) / letters[some]
        cut = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])))
    ends = np.append(cut[1:], len(doc)) - 1 if len(cut) else cut
    spans = pa.StructArray.from_arrays([pa.array(w.start[cut], pa.int32()), pa.array(w.end[ends], pa.int32()), pa.array(names[label[cut]] if len(cut) else [], pa.string())], ["start", "end", "lang"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[cut], np.arange(n + 1)), pa.int32()), spans)
    return pa.array(names[pred], pa.string()), pa.array(score), lists


def drop_unidentified(spark: SparkSession, docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", least: float = 0.4) -> DataFrame:
    """The rows of ``docs``, all columns, with a language that holds at least this share of the text; no shuffle."""
    bounded_batches(spark)
    model = train(docs, text, lang, learn)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, text):
                named, score, _ = predict(model, batch.column(batch.schema.get_field_index(text)))
                yield batch.filter(pa.array((np.asarray(named) != UNKNOWN) & (np.asarray(score) >= least)))

    return docs.mapInArrow(kept, docs.schema)


def language_spans(spark: SparkSession, docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", model: LanguageModel | None = None) -> DataFrame:
    """Rows (key, held_out, lang_pred, score, spans array<struct<start, end, lang>>), one per row of ``docs``.

    The predicted language is the one that holds most letters of the path, and the score is its share of them.
    """
    bounded_batches(spark)
    model = model or train(docs, text, lang, learn)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "text_"):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *predict(model, batch.column(2))], ["key", "held_out", "lang_pred", "score", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(~learn, F.lit(False)).alias("held_out"), F.col(text).alias("text_"))
    return rows.mapInArrow(labelled, f"key {kind}, held_out boolean, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>").withColumnRenamed("key", key)
