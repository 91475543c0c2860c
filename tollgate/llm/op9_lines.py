"""Line dedup against a sharded minimal perfect hash.

1. ``line_counts``: each line's key (ASCII white space stripped, A-Z lower-cased) becomes a
   128-bit hash; tasks count the documents of each hash before the shuffle, one aggregate
   adds the counts, and hashes found in ``min_docs`` documents or more stay.
2. ``build_index``: these hashes are dealt to shards of at most about ``SHARD_KEYS``; each
   shard becomes one file in the shared folder: a minimal perfect hash (levels of bits, each
   key owns the only set bit it falls on), an array of 64-bit fingerprints and one of counts.
3. ``probe``: tasks over the documents hash their lines again, look them up in the shard
   arrays and join the lines that stay.  Texts are never shuffled and lines never joined.

The index holds at most (distinct lines of all documents) / ``min_docs`` keys.  A task reads
shard after shard for each Arrow batch and keeps at most ``CACHE_BYTES`` of them.

Defined cases: null or empty text is one empty line; keys shorter than ``min_chars`` code
points never drop; a document counts once per key however often it repeats the line; rows
count as documents, repeated doc_ids too; a text that loses all its lines becomes empty;
empty tables give empty results; other columns travel along in ``drop_lines``.
"""

from __future__ import annotations

import hashlib
import struct
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS_BYTES, get_file, put_file, shared_dir, table, text_batches, written
from .registry import register

MIN_DOCS = 10
MIN_CHARS = 1
#: Keys of a shard (about 16 MB of arrays), and bytes of shards that a task keeps.
SHARD_KEYS = 1_000_000
CACHE_BYTES = 64 << 20


def line_key(line: bytes) -> bytes:
    return line.strip(WS_BYTES).lower()


def _hashes(keys: list) -> np.ndarray:
    """(n, 2) uint64: the 128-bit hashes of the keys."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=">u8").reshape(-1, 2).astype(np.uint64)


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def line_counts(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, text: str = "text") -> DataFrame:
    """(a, b, n): hashes of the keys found in ``min_docs`` documents or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_batches(batches, 0, max_rows=4096):
            keys: list = []
            for t in texts:
                if t:
                    keys.extend(k for k in {line_key(x) for x in t.split(b"\n")} if _long_enough(k, min_chars))
            if keys:
                h, n = np.unique(_hashes(keys), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].view(np.int64)), pa.array(h[:, 1].copy().view(np.int64)),
                                                  pa.array(n)], names=["a", "b", "n"])

    return (docs.select(F.col(text).alias("t")).mapInArrow(run, "a long, b long, n long")
            .groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class LineIndex:
    """Minimal perfect hash of 128-bit keys with fingerprints and counts."""

    def __init__(self, levels: list, prints: np.ndarray, counts: np.ndarray):
        self.levels, self.prints, self.counts = levels, prints, counts
        self.ranks, at = [], 0
        for _, words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(at + np.cumsum(ones) - ones)
            at += int(ones.sum())
        self.nbytes = prints.nbytes + counts.nbytes + sum(2 * w.nbytes for _, w in levels)

    @staticmethod
    def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        return (((_mix(keys[:, 0] ^ _mix(keys[:, 1] + salt)) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> LineIndex:
        levels, left = [], keys
        while len(left):
            size = max(64, -(-2 * len(left) // 64) * 64)
            spot = cls._spot(left, len(levels), size)
            alone = np.bincount(spot, minlength=size) == 1
            levels.append((size, np.packbits(alone, bitorder="little").view(np.uint64)))
            left = left[~alone[spot]]
            if len(levels) > 200:
                raise ValueError("repeated keys")
        out = cls(levels, np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint32))
        at = out.slots(keys)
        out.prints[at] = keys[:, 1]
        out.counts[at] = np.minimum(counts, 2**32 - 1)
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The array slot of each key; -1 where no level has a bit for it."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, ((size, words), ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(todo):
                break
            spot = self._spot(keys[todo], level, size)
            word, bit = words[spot >> 6], (spot & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[here]] = (ranks[spot >> 6] + below)[here]
            todo = todo[~here]
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The stored count of each key, 0 for keys that are not in the index."""
        at = self.slots(keys)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64)
        known = (at >= 0) & (self.prints[at] == keys[:, 1])
        return np.where(known, self.counts[at], 0).astype(np.int64)

    def to_bytes(self) -> bytes:
        head = struct.pack("<4sII", b"LIX1", len(self.levels), len(self.prints))
        sizes = struct.pack(f"<{len(self.levels)}Q", *(s for s, _ in self.levels))
        return b"".join([head, sizes, *(w.tobytes() for _, w in self.levels), self.prints.tobytes(), self.counts.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> LineIndex:
        magic, n_levels, n = struct.unpack_from("<4sII", data)
        if magic != b"LIX1":
            raise ValueError("not a line index")
        sizes = struct.unpack_from(f"<{n_levels}Q", data, 12)
        at, levels = 12 + 8 * n_levels, []
        for s in sizes:
            levels.append((s, np.frombuffer(data, np.uint64, s // 64, at)))
            at += s // 8
        return cls(levels, np.frombuffer(data, np.uint64, n, at), np.frombuffer(data, np.uint32, n, at + 8 * n))


def build_index(spark: SparkSession, counts: DataFrame) -> tuple[str, int]:
    """Writes the shard files; returns their folder and their number."""
    counts = written(spark, counts, "line-counts")
    shards = max(1, -(-counts.count() // SHARD_KEYS))
    folder = shared_dir(spark, "line-index")

    def run(t: pa.Table) -> pa.Table:
        keys = np.stack([t.column(c).to_numpy().view(np.uint64) for c in ("a", "b")], axis=1)
        index = LineIndex.build(keys, t.column("n").to_numpy())
        shard = t.column("shard")[0].as_py()
        put_file(f"{folder}/{shard:06d}.lix", index.to_bytes())
        return pa.table({"shard": [shard], "n_keys": [len(keys)]})

    made = (counts.withColumn("shard", F.pmod(F.shiftrightunsigned("a", 40), F.lit(shards)))
            .groupBy("shard").applyInArrow(run, "shard long, n_keys long"))
    there = {r.shard for r in made.select("shard").collect()}  # one row per million keys
    for shard in set(range(shards)) - there:  # no key fell into it
        put_file(f"{folder}/{shard:06d}.lix", LineIndex.build(np.zeros((0, 2), np.uint64), np.zeros(0)).to_bytes())
    return folder, shards


class _Shards:
    """The shard files of a folder, the last used of them kept."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards, self.kept, self.size = folder, shards, OrderedDict(), 0

    def _shard(self, s: int) -> LineIndex:
        if s not in self.kept:
            index = LineIndex.from_bytes(get_file(f"{self.folder}/{s:06d}.lix"))
            while self.kept and self.size + index.nbytes > CACHE_BYTES:
                self.size -= self.kept.popitem(last=False)[1].nbytes
            self.kept[s], self.size = index, self.size + index.nbytes
        self.kept.move_to_end(s)
        return self.kept[s]

    def count(self, keys: np.ndarray) -> np.ndarray:
        where = ((keys[:, 0] >> np.uint64(40)) % np.uint64(self.shards)).astype(np.int64)
        out = np.zeros(len(keys), np.int64)
        for s in np.unique(where).tolist():
            at = np.flatnonzero(where == s)
            out[at] = self._shard(s).count(keys[at])
        return out


def _clean(texts: list, shards: _Shards, min_docs: int, min_chars: int) -> Iterator[tuple[int, int, bytes | None]]:
    """(lines, dropped lines, text that stays) for each text."""
    split = [(t or b"").split(b"\n") for t in texts]
    keys = {k: i for i, k in enumerate({line_key(x) for lines in split for x in lines})}
    flat = list(keys)
    count = shards.count(_hashes(flat)) if flat else np.zeros(0)
    drop = {k for k, n in zip(flat, count.tolist()) if n >= min_docs and _long_enough(k, min_chars)}
    for t, lines in zip(texts, split):
        left = [x for x in lines if line_key(x) not in drop] if drop else lines
        yield len(lines), len(lines) - len(left), t if len(left) == len(lines) else b"\n".join(left)


def dropped_lines(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 for every row of ``docs``."""
    folder, n = build_index(spark, line_counts(docs, min_docs, min_chars))
    narrow = docs.select("doc_id", F.col("text").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder, n)
        for batch, texts in text_batches(batches, 1, max_rows=4096):
            rows = list(_clean(texts, shards, min_docs, min_chars))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r[2] or b"").hexdigest() for r in rows])],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return narrow.mapInArrow(run, narrow.select("doc_id").schema.add("n_lines", "long").add("n_dropped", "long")
                             .add("kept_sha256", "string"))


def drop_lines(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the lines that stay as text; a column ``n_chars``, if there is one, follows
    the text where lines went."""
    folder, n = build_index(spark, line_counts(docs, min_docs, min_chars, text))
    at = docs.columns.index(text)
    chars = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder, n)
        for batch, texts in text_batches(batches, at, max_rows=4096):
            rows = list(_clean(texts, shards, min_docs, min_chars))
            columns = list(batch.columns)
            left = [None if t is None else r[2].decode("utf-8", "replace") for t, r in zip(texts, rows)]
            columns[at] = pa.array(left, batch.schema.field(at).type)
            if chars is not None:
                old = columns[chars].to_pylist()
                columns[chars] = pa.array([len(t) if r[1] else o for t, r, o in zip(left, rows, old)],
                                          batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key AS hot FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(hot) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE hot IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.hot GROUP BY rid, doc_id
"""


@register("op9_line_dedup", ORACLE)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_lines(spark, table(spark, sf_dir, "documents"))
