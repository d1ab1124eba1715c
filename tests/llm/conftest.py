from __future__ import annotations

import pyarrow as pa
import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table with columns that clash with the operators' own names."""

    def build(rows):
        full = [(i, t, lang, source, None if t is None else len(t), "key", "1", 7) for i, t, lang, source in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, key string, doc string, score int").repartition(2)

    return build


#: Texts that every text operator meets: null, empty, blank, odd scripts, very long, repeated.
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "  \n\t ", None, None), (4, "don't PANIC! 12 ünïcödé 日本語 ça va?", "fr", "b"), (5, "tab\tand  two  spaces \n x", None, "b"),
    (6, "word " * 5000, "en", "a"), (7, "x" * 3000, "en", "c"), (8, "don't PANIC! 12 ünïcödé 日本語 ça va?", "fr", "b"), (9, "𝒳 emoji 🙂 é \x1c y z", None, "d"), (10, "…!?", "en", "a"),
    (11, "привет мир это русский текст", None, "e"), (12, "a", "en", "a"), (13, "one two three", "en", "a"), (13, "one two three", "en", "a"), (None, "no key here at all", "en", "a"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD


@pytest.fixture(scope="session")
def strings():
    return lambda xs: pa.array(xs, pa.string())
