"""Quality rules by repetition coverage.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text.  Words get numbers, numbers get random
64-bit values, and rolling hashes over them give the hash of every n-gram of each length
in numpy, for many texts at a time.  A word is covered at length n if it lies in an n-gram
that occurs twice or more in its text.  Coverage is measured in characters, so long
repeated passages weigh more than short ones.

Verdict: ``base_failed`` as the contract says; otherwise a text is rejected if the
characters inside duplicated n-grams exceed that length's share of all word characters,
or the characters of duplicated lines exceed their share, or symbols outnumber
``max_symbol_share`` of the words.  Limits are parameters (``Limits``).

A longer n-gram can repeat only where its first words already repeat, so lengths are done in
rising order and only at positions still open; nothing is sampled.

Defined cases: null text counts as no words (base_failed, rejected); empty text likewise;
very long texts are split into words in pieces; repeated rows are judged each alone; other
columns are ignored by ``measures`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS_BYTES, table, text_batches
from .registry import register

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Largest accepted shares; n-gram length -> share of word characters covered."""

    min_words: int = 10
    max_repeat_words_percent: int = 20
    ngram_chars: tuple = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))
    line_chars: float = 0.20
    max_symbol_share: float = 0.30


@dataclass
class Texts:
    """Words of several texts on one axis: ids, text number of each word, distinct words."""

    ids: np.ndarray
    text: np.ndarray
    words: list


def _number(texts: list, piece: int = 1 << 20) -> Texts:
    seen: dict = {}
    parts, counts = [], []
    for t in texts:
        n, at = 0, 0
        t = t or b""
        while at < len(t):
            end = at + piece
            if end < len(t):  # up to the next white space
                ends = [e for w in WS_BYTES if (e := t.find(bytes((w,)), end, end + (1 << 16))) >= 0]
                while not ends and end + (1 << 16) < len(t):
                    end += 1 << 16
                    ends = [e for w in WS_BYTES if (e := t.find(bytes((w,)), end, end + (1 << 16))) >= 0]
                end = min(ends) if ends else len(t)
            words = t[at:end].split()
            parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)))
            n += len(words)
            at = end
        counts.append(n)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Texts(ids, np.repeat(np.arange(len(texts)), counts), list(seen))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0xD6E8FEB86659FD93)


def _twice(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur twice or more."""
    s = np.sort(keys)
    again = s[1:][s[1:] == s[:-1]]
    if not len(again):
        return np.zeros(len(keys), bool)
    again = np.unique(again)
    seen = np.zeros(1 << 16, bool)
    seen[again >> np.uint64(48)] = True
    out = seen[keys >> np.uint64(48)]
    at = np.flatnonzero(out)
    where = np.minimum(np.searchsorted(again, keys[at]), len(again) - 1)
    out[at] = again[where] == keys[at]
    return out


def coverage(t: Texts, lengths: tuple) -> dict:
    """For each n: mask of the words inside an n-gram that occurs twice or more in its text."""
    out, n_words = {}, len(t.ids)
    value, salt = _mix(t.ids + 1), _mix(t.text + (1 << 40))
    open_at, rolled, done = np.arange(n_words), None, 0
    for n in sorted(lengths):
        open_at = open_at[open_at + n <= n_words]
        open_at = open_at[t.text[open_at] == t.text[open_at + n - 1]] if len(open_at) else open_at
        if rolled is None:
            rolled = np.zeros(n_words, np.uint64)
        for k in range(done, n):  # rolled[i] = hash of the words i .. i+k
            longer = rolled[:max(0, n_words - k)]
            longer *= BASE
            longer += value[k:]
        done = n
        mask = np.zeros(n_words + 1, np.int32)
        if len(open_at):
            open_at = open_at[_twice(_mix(rolled[open_at] ^ salt[open_at]))]
            np.add.at(mask, open_at, 1)
            np.add.at(mask, open_at + n, -1)
        out[n] = np.cumsum(mask[:-1]) > 0
    return out


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(texts: list, limits: Limits = Limits()) -> dict:
    """Columns of measures and verdicts for a list of UTF-8 texts (None: no words)."""
    lengths = tuple(sorted({5, *(n for n, _ in limits.ngram_chars)}))
    t = _number(texts)
    cover = coverage(t, lengths)
    count = len(texts)
    n_words = np.bincount(t.text, minlength=count)
    repeat = np.bincount(t.text[cover[5]], minlength=count)
    chars_of = np.fromiter((len(w.decode("utf-8", "replace")) for w in t.words), np.int64, len(t.words))
    chars = chars_of[t.ids] if len(t.ids) else t.ids
    word_chars = np.bincount(t.text, chars, minlength=count).astype(np.int64)
    shares = {n: np.bincount(t.text[cover[n]], chars[cover[n]], minlength=count) / np.maximum(word_chars, 1)
              for n, _ in limits.ngram_chars}
    symbols, dup_lines, line_share = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count)
    for i, text in enumerate(texts):
        if not text:
            continue
        symbols[i] = len(text) - len(text.translate(None, SYMBOLS))
        if b"\n" in text:
            seen, dup, total = set(), 0, 0
            for line in text.split(b"\n"):
                if line.strip(WS_BYTES):
                    total += len(line)
                    if line in seen:
                        dup += len(line)
                        dup_lines[i] += 1
                    else:
                        seen.add(line)
            line_share[i] = dup / max(total, 1)
    failed = (n_words < limits.min_words) | (100 * repeat > limits.max_repeat_words_percent * n_words)
    kept = ~failed & (line_share <= limits.line_chars) & (symbols <= limits.max_symbol_share * n_words)
    for n, most in limits.ngram_chars:
        kept &= shares[n] <= most
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
           "n_repeat_words": repeat, "base_failed": failed, "kept": kept, "dup_line_share": line_share}
    return out | {f"dup_{n}gram_share": shares[n] for n, _ in limits.ngram_chars}


def _schema(limits: Limits) -> list[tuple[str, str]]:
    return ([(f, "long") for f in FIELDS] + [("base_failed", "boolean"), ("kept", "boolean"), ("dup_line_share", "double")]
            + [(f"dup_{n}gram_share", "double") for n, _ in limits.ngram_chars])


def measures(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id with all measures and the verdict, one row per row of ``docs``."""
    narrow = docs.select("doc_id", F.col("text").alias("t"))
    fields = _schema(limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1, max_rows=2048, max_bytes=2 << 20):
            m = measure(texts, limits)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(m[f]) for f, _ in fields]],
                                             names=["doc_id", *[f for f, _ in fields]])

    schema = narrow.select("doc_id").schema
    for f, kind in fields:
        schema = schema.add(f, kind)
    return narrow.mapInArrow(run, schema)


def keep(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules accept, all columns, in one pass."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, at, max_rows=2048, max_bytes=2 << 20):
            yield batch.filter(pa.array(measure(texts, limits)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def oracle(limits: Limits = Limits()) -> str:
    """The same measures in SQL: n-grams as joined strings, coverage by sliding windows."""
    lengths = sorted({5, *(n for n, _ in limits.ngram_chars)})
    blank = r"[^\x20\x09-\x0D]"

    def gram(n):
        return " || ' ' || ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, n)]])
    shares = [f"coalesce(CAST(c.chars{n} AS DOUBLE), 0) / greatest(c.word_chars, 1) AS dup_{n}gram_share" for n, _ in limits.ngram_chars]
    inside = " AND ".join(f"dup_{n}gram_share <= {most}" for n, most in limits.ngram_chars)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{blank}+') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT rid, i, word, {', '.join(f'{gram(n)} AS g{n}' for n in lengths)} FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
u AS (SELECT rid, i, word, {', '.join(f'g{n} IS NOT NULL AND count(*) OVER (PARTITION BY rid, g{n}) > 1 AS u{n}' for n in lengths)} FROM g),
v AS (SELECT rid, length(word) AS n, {', '.join(
        f'bool_or(u{n}) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS v{n}' for n in lengths)} FROM u),
c AS (SELECT rid, count(*) AS n_words, sum(n) AS word_chars, count(*) FILTER (WHERE v5) AS n_repeat_words,
             {', '.join(f'sum(n) FILTER (WHERE v{n}) AS chars{n}' for n in lengths)} FROM v GROUP BY rid),
x AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
y AS (SELECT rid, line, row_number() OVER (PARTITION BY rid, line) > 1 AS again FROM x WHERE regexp_matches(line, '{blank}')),
z AS (SELECT rid, count(*) FILTER (WHERE again) AS n_dup_lines,
             CAST(coalesce(sum(strlen(line)) FILTER (WHERE again), 0) AS DOUBLE) / greatest(sum(strlen(line)), 1) AS dup_line_share
      FROM y GROUP BY rid),
m AS (SELECT doc_id, coalesce(c.n_words, 0) AS n_words, CAST(coalesce(c.word_chars, 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(z.n_dup_lines, 0) AS n_dup_lines,
             coalesce(c.n_repeat_words, 0) AS n_repeat_words, coalesce(z.dup_line_share, 0) AS dup_line_share,
             {', '.join(shares).replace('greatest(c.word_chars, 1)', 'greatest(coalesce(c.word_chars, 0), 1)')}
      FROM d LEFT JOIN c USING (rid) LEFT JOIN z USING (rid)),
f AS (SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_words_percent} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND dup_line_share <= {limits.line_chars} AND n_symbols <= CAST({limits.max_symbol_share} AS DOUBLE) * n_words
          AND {inside} AS kept FROM f
"""


ORACLE = oracle()


@register("op5_quality_rules", ORACLE)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures(table(spark, sf_dir, "documents"))
