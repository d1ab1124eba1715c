"""URL filters: rules indexed by their rarest literal token.

A rule blocks or allows by two regular expressions, one for the whole host and one for the beginning of
the path, and names literal tokens that every url it fits must hold. Each rule is indexed under the one of
its tokens that the fewest urls hold (counted over the whole table by a Spark aggregation whose result is
bounded by the rules' tokens). A url's tokens then fetch candidate rules from that index and only these run
their regular expressions. The longest fitting rule wins.

Defined cases: a null url or one without ``://`` has empty host and path, fits no host rule and is blocked
as unusable; repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile("[A-Za-z0-9]+")
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class UrlRule:
    """``text`` names the rule, and its length ranks it; ``tokens`` are ``h:`` host or ``p:`` path tokens."""

    text: str
    action: str
    host: str
    path: str
    tokens: tuple[str, ...]
    listed: bool = True


def site_rule(action: str, text: str) -> UrlRule:
    """``host/path``: fits that host and its subdomains where the path starts with ``/path``."""
    host, slash, path = text.partition("/")
    path = slash + path
    inner = _TOKEN.findall(path) if path.endswith("/") else _TOKEN.findall(path)[: -1 if path and _TOKEN.match(path[-1]) else None]
    tokens = [f"h:{t}" for t in _TOKEN.findall(host.translate(_LOWER))] + [f"p:{t}" for t in inner]
    return UrlRule(text, action, rf"(?:.*\.)?{re.escape(host.translate(_LOWER))}", re.escape(path), tuple(tokens))


def host_pattern(name: str, pattern: str, tokens: Iterable[str], action: str = "block") -> UrlRule:
    """A pattern over the whole host; where it alone fits, it gives the verdict but no rule text."""
    return UrlRule(name, action, pattern, "", tuple(f"h:{t}" for t in tokens), listed=False)


#: The rules of the registered query.
SITE_RULES = (
    site_rule("block", "com/en/"),
    site_rule("allow", "example.com/en/7"),
    site_rule("allow", "net/de/"),
    site_rule("block", "example.net/de/8"),
    site_rule("block", "org/es/"),
)
#: Host patterns that block what no site rule decides.
HOST_PATTERNS = (
    host_pattern("pills", r".*\b(?:cheap|buy|online)-pills\b.*", ["pills"]),
    host_pattern("farm", r".*\b(?:spam|link|content)-farm\b.*", ["farm"]),
    host_pattern("casino", r".*\b(?:free|best|online)-casino\b.*", ["casino"]),
    host_pattern("warez", r".*\b(?:free-)?warez\b.*", ["warez"]),
)


def split_url(url: str | None) -> tuple[str, str]:
    found = _PARTS.search(url) if url else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


def _keys(url: Column) -> Column:
    """A url's distinct tokens, as ``h:`` and ``p:`` keys."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    found = lambda x, kind: F.transform(F.regexp_extract_all(x, F.lit("([A-Za-z0-9]+)")), lambda t: F.concat(F.lit(kind), t))
    return F.array_distinct(F.concat(found(host, "h:"), found(path, "p:")))


def token_counts(urls: DataFrame, url: str, rules: Iterable[UrlRule]) -> dict[str, int]:
    """How many urls hold each literal token of the rules; at most one row a token reaches the driver."""
    tokens = sorted({t for r in rules for t in r.tokens})
    held = F.array_intersect(_keys(F.col(url)), F.array(*[F.lit(t) for t in tokens]))
    return {r["token"]: r["n"] for r in urls.select(F.explode(held).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()} if tokens else {}


def rule_index(rules: Iterable[UrlRule], counts: dict[str, int]) -> dict[str | None, list[UrlRule]]:
    """Rules under their rarest token; those without a literal token under None, which every url fetches."""
    index: dict[str | None, list[UrlRule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None), []).append(rule)
    return index


def judge_urls(urls: DataFrame, key: str = "page_id", url: str = "url", rules: Iterable[UrlRule] = SITE_RULES, patterns: Iterable[UrlRule] = HOST_PATTERNS) -> DataFrame:
    """Rows (key, host, path, rule, verdict, n_candidates): one per url.

    A fitting site rule gives rule and verdict (the longest; of equally long ones the first by text);
    else fitting host patterns block; else the url is allowed.
    """
    rules = (*rules, *patterns)
    index = rule_index(rules, token_counts(urls, url, rules))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r.text: (re.compile(r.host, re.S), re.compile(r.path, re.S)) for r in rules}
        always = index.get(None, [])
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                host, path = split_url(text)
                tokens = {f"h:{t}" for t in _TOKEN.findall(host)} | {f"p:{t}" for t in _TOKEN.findall(path)}
                candidates = [r for t in tokens for r in index.get(t, ())] + always
                fits = [r for r in candidates if compiled[r.text][0].fullmatch(host) and compiled[r.text][1].match(path)]
                site = min((r for r in fits if r.listed), key=lambda r: (-len(r.text), r.text), default=None)
                usable = bool(text) and "://" in text
                verdict = site.action if site else "block" if fits or not usable else "allow"
                out.append((host, path, site.text if site else None, verdict, len(candidates)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32()), strict=True))],
                ["key", "host", "path", "rule", "verdict", "n_candidates"],
            )

    kind = urls.schema[key].dataType.simpleString()
    return urls.select(key, url).mapInArrow(judged, f"key {kind}, host string, path string, rule string, verdict string, n_candidates int").withColumnRenamed("key", key)


def _sql() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fits, acts = [], []
    for r in sorted(SITE_RULES, key=lambda r: -len(r.text)):
        host, _, path = r.text.partition("/")
        test = f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"
        fits.append(f"WHEN {test} THEN '{r.text}'")
        acts.append(f"WHEN {test} THEN '{r.action}'")
    spam = " OR ".join(f"regexp_full_match(host, '{r.host}', 's')" for r in HOST_PATTERNS)
    return f"""
WITH cut AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, url, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, CASE {' '.join(fits)} ELSE NULL END AS rule,
  CASE {' '.join(acts)} WHEN {spam} THEN 'block' WHEN url IS NULL OR strpos(url, '://') = 0 THEN 'block' ELSE 'allow' END AS verdict
FROM parts"""


ORACLE_SQL = _sql()
