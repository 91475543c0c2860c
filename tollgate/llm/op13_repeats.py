"""Substring dedup with repeated-phrase automata.

A window is ``window`` (50) consecutive words of one document.  A word goes if a window that
covers it also starts in a document with a smaller doc_id.

1. Recurring phrases.  Of every window the phrase of window / 2 words with the smallest rolling
   hash is its anchor, so equal windows have equal anchors, and about 7 % of all positions are
   anchors.  Anchors found in two documents or more are recurring; documents without one cannot
   hold a repeated window and are finished here.  Texts are joined to their anchors once.
2. Recurring passages are confirmed among the windows whose anchor recurs: one aggregate keeps
   the smallest and largest doc_id of each window hash.  Runs of such windows in their smallest
   document are the passages.
3. Automata.  Passages are dealt to shards by their document.  A shard's passages are cut into
   phrases of ``tile`` words such that every window holds a whole one, and pyahocorasick compiles
   these into one automaton, a file of the shared folder, with the passages' words beside it.
4. Streaming.  The parts of documents that hold confirmed windows go to the shards of their
   passages (so work grows with the repeated text, not with documents times shards); busy shards
   are read by many tasks.  Each occurrence of a phrase is extended word by word along the
   passage; a common run of ``window`` words or more is a span to remove.

Hashes only choose candidates and shards: every removed word has been compared word by word.
Two different windows or phrases of one 64-bit hash can at worst hide a repeat.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Defined cases: null or empty texts have no words;
documents shorter than a window lose nothing; null doc_ids count as larger than any id, and
rows of one id are no repeats of each other; repeated rows each give a result; windows overlap
freely, inside one document repeats stay; texts of any length are read whole; empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import get_file, put_file, shared_dir, shuffles_removed, table, text_batches, written
from .registry import register

WINDOW = 50
#: Words of an automaton's phrases.
TILE = 12
#: Confirmed windows of a shard (about 20 MB of automaton) and document parts that one task of a shard reads.
SHARD_WINDOWS = 200_000
PART_ROWS = 5_000
NO_ID = 2**63 - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each word of the text."""
    b = np.frombuffer(text, np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    first = ~space
    first[1:] &= space[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.uint64)
    b, space = b[start[0]:], space[start[0]:]
    start = start - start[0]
    place = np.arange(len(b)) - np.repeat(start, np.diff(start, append=len(b)))
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE, np.uint64))
    return _mix(np.add.reduceat(np.where(space, np.uint64(0), (b + np.uint64(1)) * powers[place]), start))


def _joined(a: np.ndarray, b: np.ndarray, length: int, width: int) -> np.ndarray:
    """Hashes of ``width`` words, then ``length`` words, from the hashes of either."""
    n = min(len(a), len(b) - width)
    return a[:n] * np.uint64(pow(int(_BASE), length, 2**64)) + b[width:width + n]


def rolling(words: np.ndarray, length: int) -> np.ndarray:
    """The polynomial hash of every run of ``length`` words (doubling steps)."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    out, width, power, step = None, 0, words, 1
    while True:
        if length & step:
            out, width = (power, step) if out is None else (_joined(out, power, step, width), width + step)
        if 2 * step > length:
            return out
        power, step = _joined(power, power, step, step), 2 * step


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase hashes of all positions, the anchor's position of every window)."""
    phrase = window // 2
    g = _mix(rolling(words, phrase))
    if len(words) < window:
        return g, np.zeros(0, np.int64)
    among = np.lib.stride_tricks.sliding_window_view(g, window - phrase + 1)
    return g, among.argmin(axis=1) + np.arange(len(among))


def _batch(schema: str, *columns) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(list(columns), names=names)


def _many(values: list, kind: type) -> pa.Array:
    return pa.array(np.concatenate(values).astype(kind) if values else np.zeros(0, kind))


def _found_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 2):
            did, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows, a, p = [], [], []
            for i, t in enumerate(texts):
                g, at = anchors(word_hashes(t), window)
                at = np.unique(at)
                rows.append(np.full(len(at), i)), a.append(g[at].view(np.int64)), p.append(at)
            r = np.concatenate(rows)
            yield _batch(ANCHORS, pa.array(did[r]), pa.array(h[r]), _many(a, np.int64), _many(p, np.int32))

    return run


ANCHORS = "did long, h long, a long, p int"
MARKED = "did long, h long, doc_id long, n_words long, digest string, words string, ps array<int>"
WINDOWS = "w long, did long, h long, pos int"
SPANS = "did long, h long, s int, e int"


def _marked(texts_too: bool):
    """Finishes documents without recurring phrases; of the others, keeps their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 3):
            n, digest, kept = [], [], []
            for t, hit in zip(texts, batch.column(4).is_valid().to_pylist()):
                words = t.split()
                whole = b" ".join(words)
                n.append(len(words))
                digest.append(None if hit else hashlib.sha256(whole).hexdigest())
                kept.append(whole.decode("utf-8", "replace") if hit or texts_too else None)
            yield _batch(MARKED, *batch.columns[:3], pa.array(n, pa.int64()), pa.array(digest, pa.string()),
                         pa.array(kept, pa.string()), batch.column(4))

    return run


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 2):
            did, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows, w, pos = [], [], []
            for i, (t, ps) in enumerate(zip(texts, batch.column(3).to_pylist())):
                words = word_hashes(t)
                at = np.flatnonzero(np.isin(anchors(words, window)[1], ps))
                rows.append(np.full(len(at), i)), w.append(_mix(rolling(words, window))[at].view(np.int64)), pos.append(at)
            r = np.concatenate(rows)
            yield _batch(WINDOWS, _many(w, np.int64), pa.array(did[r]), pa.array(h[r]), _many(pos, np.int32))

    return run


def _passages(window: int):
    """Runs of confirmed windows of their smallest document, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 2):
            shard, did, out = [], [], []
            for s, d, t, ps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, batch.column(3).to_pylist()):
                words, ps = t.split(b" "), np.array(ps)
                for run_ in np.split(ps, np.flatnonzero(np.diff(ps) != 1) + 1):
                    shard.append(s), did.append(d)
                    out.append(b" ".join(words[run_[0]:run_[-1] + window]).decode())
            yield _batch("shard, did, words", pa.array(shard, pa.int64()), pa.array(did, pa.int64()), pa.array(out, pa.string()))

    return run


class Shard:
    """The passages of a shard and the automaton over their phrases."""

    def __init__(self, passages: list, window: int, tile: int):
        self.window, self.tile = window, tile
        self.owners = [d for d, _ in passages]
        self.words = [t.split(" ") for _, t in passages]
        self.places: list = []  # of each phrase: (passage, word)
        numbers: dict = {}
        self.automaton = ahocorasick.Automaton()
        for k, words in enumerate(self.words):
            for at in range(0, len(words) - tile + 1, window - tile + 1):
                phrase = f" {' '.join(words[at:at + tile])} "
                if (i := numbers.setdefault(phrase, len(numbers))) == len(self.places):
                    self.places.append([])
                    self.automaton.add_word(phrase, (i, len(phrase)))
                self.places[i].append((k, at))
        self.automaton.make_automaton()

    def spans(self, text: str, below: int) -> list[tuple[int, int]]:
        """Word spans of the text (words joined by single spaces) that are runs of ``window`` words or
        more of a passage of a document smaller than ``below``."""
        words, found = text.split(" "), []
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
        seen: dict = {}  # (passage, shift) -> end of the run last compared
        for end, (i, length) in self.automaton.iter(f" {text} "):
            p = int(np.searchsorted(starts, end - length + 1))
            for k, q in self.places[i]:
                if self.owners[k] >= below or seen.get((k, p - q), -1) > p:
                    continue
                other, s, e = self.words[k], p, p + self.tile
                limit = min(len(words), p - q + len(other))
                while s > 0 and s > p - q and words[s - 1] == other[s - 1 - p + q]:
                    s -= 1
                while e < limit and words[e] == other[e - p + q]:
                    e += 1
                seen[k, p - q] = e
                if e - s >= self.window:
                    found.append((s, e))
        return found


def _compile(folder: str, window: int, tile: int):
    def run(t: pa.Table) -> pa.Table:
        shard = t.column("shard")[0].as_py()
        passages = sorted(set(zip(t.column("did").to_pylist(), t.column("words").to_pylist())))
        put_file(f"{folder}/{shard:07d}.aho", pickle.dumps(Shard(passages, window, tile)))
        return pa.table({"shard": [shard], "n": [len(passages)]})

    return run


def _located(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            out = []
            for s, d, h, first, text in zip(*(c.to_pylist() for c in batch.columns)):
                if s != at:
                    shard = None  # one automaton at a time
                    at, shard = s, pickle.loads(get_file(f"{folder}/{s:07d}.aho"))
                out += [(d, h, a + first, b + first) for a, b in shard.spans(text, d)]
            cols = list(zip(*out)) if out else [[]] * 4
            yield _batch(SPANS, *[pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))])

    return run


def _finish(texts_too: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 2):
            removed, out = [], []
            for t, spans in zip(texts, batch.column(3).to_pylist()):
                words = t.split(b" ") if t else []
                go = np.zeros(len(words) + 1, np.int64)
                for x in spans or []:
                    go[x["s"]] += 1
                    go[x["e"]] -= 1
                go = np.cumsum(go)[:-1] > 0
                left = b" ".join([w for w, x in zip(words, go.tolist()) if not x]) if go.any() else t
                removed.append(int(go.sum()))
                out.append(left.decode() if texts_too else hashlib.sha256(left).hexdigest())
            yield _batch("doc_id, n_words, n_removed, kept", *batch.columns[:2], pa.array(removed, pa.int64()), pa.array(out, pa.string()))

    return run


def without_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, tile: int = TILE, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by single spaces; with
    ``texts`` False their sha256) of every row of ``docs`` (doc_id, text)."""
    with shuffles_removed(spark):
        marked, spans = repeated_spans(spark, docs, window, tile, texts)
    done = marked.where(F.col("ps").isNull()).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("words" if texts else "digest").alias("kept"))
    by_row = spans.groupBy("did", "h").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    rest = marked.where(F.col("ps").isNotNull()).join(by_row, ["did", "h"], "left")
    return done.unionByName(rest.select("doc_id", "n_words", "words", "spans").mapInArrow(
        _finish(texts), "doc_id long, n_words long, n_removed long, kept string"))


def repeated_spans(spark: SparkSession, docs: DataFrame, window: int, tile: int, texts: bool) -> tuple[DataFrame, DataFrame]:
    """The written rows (did, h: the id, ``NO_ID`` for null, and a hash of the text) and the
    word spans (did, h, s, e) that repeat smaller documents."""
    tile = max(1, min(tile, window // 2))
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(text).alias("h"),
                       F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    # 1. recurring phrases
    phrases = written(spark, base.select("did", "h", "t").mapInArrow(_found_anchors(window), ANCHORS), "repeat-anchors")
    # written tables of their own: the joins below are then dealt anew, and a hot key's rows can be split
    recurring = phrases.groupBy("a").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).where("lo < hi").select("a")
    recurring = written(spark, recurring, "repeat-phrases")
    hits = phrases.join(recurring, "a").groupBy("did", "h").agg(F.sort_array(F.collect_set("p")).alias("ps"))
    marked = written(spark, base.join(hits, ["did", "h"], "left").select("did", "h", "doc_id", "t", "ps")
                     .mapInArrow(_marked(texts), MARKED), "repeat-marked")
    # 2. recurring passages
    suspects = marked.where(F.col("ps").isNotNull())
    windows = suspects.select("did", "h", "words", "ps").mapInArrow(_windows(window), WINDOWS)
    confirmed = windows.groupBy("w").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).where("lo < hi").select("w", "lo")
    confirmed = written(spark, confirmed, "repeat-confirmed")
    found = written(spark, windows.join(confirmed, "w").select("did", "h", "pos", "lo"), "repeat-windows")
    owned = found.where("did = lo")
    shards = max(1, -(-owned.count() // SHARD_WINDOWS))

    def shard_of(did: str):
        return F.pmod(F.xxhash64(did), F.lit(shards)).alias("shard")

    # 3. automata
    runs = owned.groupBy("did", "h").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    passages = suspects.select("did", "h", "words").dropDuplicates(["did", "h"]).join(runs, ["did", "h"]).select(
        shard_of("did"), "did", "words", "at").mapInArrow(_passages(window), "shard long, did long, words string")
    folder = shared_dir(spark, "repeat-automata")
    passages.groupBy("shard").applyInArrow(_compile(folder, window, tile), "shard long, n long").agg(F.sum("n")).collect()  # one number
    # 4. streaming
    routes = found.where("did > lo").groupBy("did", "h", shard_of("lo")).agg(F.min("pos").alias("s"), (F.max("pos") + window).alias("e"))
    parts = routes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART_ROWS)).alias("parts"))
    streamed = (suspects.select("did", "h", "words").dropDuplicates(["did", "h"]).join(routes.join(parts, "shard"), ["did", "h"])
                .select("shard", F.pmod("h", "parts").alias("part"), "did", "h", "s",
                        F.array_join(F.slice(F.split("words", " "), F.col("s") + 1, F.col("e") - F.col("s")), " ").alias("text"))
                .repartition("shard", "part").sortWithinPartitions("shard")
                .select("shard", "did", "h", "s", "text").mapInArrow(_located(folder), SPANS))
    return marked, written(spark, streamed, "repeat-spans")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS did,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
n AS (SELECT rid, did, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
      FROM (SELECT rid, did, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT s, min(did) AS lo FROM n GROUP BY s HAVING min(did) < max(did)),
r AS (SELECT DISTINCT rid, i + j AS k FROM n JOIN f USING (s), range(0, 50) AS t(j) WHERE lo < did),
g AS (SELECT rid, list(k) AS gone FROM r GROUP BY rid),
u AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM d),
t AS (SELECT u.rid, string_agg(x, ' ' ORDER BY u.k) AS kept FROM u ANTI JOIN r ON u.rid = r.rid AND u.k = r.k GROUP BY u.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (rid) LEFT JOIN t USING (rid)
"""


@register("op13_substring_dedup", ORACLE)
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark, table(spark, sf_dir, "documents"), texts=False).withColumnRenamed("kept", "kept_sha256")
