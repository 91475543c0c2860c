"""SimHash near-duplicates by meet-in-the-middle ball hashing.

``fingerprints``: ASCII-lower-cased words ``[^\\x20\\x09-\\x0D]+``, shingles of four words
joined by spaces (repeats count; fewer words: the whole sequence; none: fingerprint 0),
XXH64 with seed 42 of each; bit b is 1 if set in over half of the hashes.

``near_components``: two fingerprints at distance d <= 2r share a point within r of
both.  Every distinct fingerprint emits its ball of radius r = distance / 2 (2081 points
for 4 bits), points are shuffled, and fingerprints that meet at a point are linked.  The
shuffle goes by a few chosen bits of the point: a fingerprint is sent once to each bucket
its ball reaches (at most 1 + B + C(B, 2) of them), and the receiving task makes only the
points of that bucket.  The shuffle then holds 8-byte fingerprints, not 2081 points each.

Inside a bucket all fingerprints at one point are linked to the smallest of them (any
two are within 2r by the triangle inequality; the popcount is checked again), and the
bucket sends out a spanning forest, so a crowded ball never emits all its pairs.
Buckets that would make too many points are split by further bits, again exactly.

Defined cases: null text has no words; null doc_id keeps its row and takes part, but the
component id is the smallest non-null doc_id (null if there is none); repeated rows are
each returned; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, table, text_batches, written
from .registry import register

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Points that one bucket may make at a time; more are made in parts.
POINTS = 4_000_000
#: Words of one text that are hashed at a time.
WORDS_AT_ONCE = 500_000


def simhash(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: ASCII letters and the contract's white space only
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle_words + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, WORDS_AT_ONCE):
        part = words[at:at + WORDS_AT_ONCE + shingle_words - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[:len(part) - shingle_words + 1].tolist(), ends[shingle_words - 1:].tolist())
        hashed = xxhash.xxh64_intdigest
        h = np.array([hashed(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        for k in range(0, len(h), 8192):
            bits = np.unpackbits(h[k:k + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, keys: tuple = ("doc_id",),
                 text: str = "text") -> DataFrame:
    """``keys`` and ``fp``, the fingerprint as a signed long."""
    narrow = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))
    schema = narrow.drop("t").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(keys)
        for batch, texts in text_batches(batches, at):
            fp = np.array([simhash(t, shingle_words) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(fp)],
                                             names=[*batch.schema.names[:at], "fp"])

    out = narrow.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "fp")


def _flips(bits: list[int], radius: int) -> np.ndarray:
    """All masks with at most ``radius`` of the given bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1)
                     for c in itertools.combinations(bits, r)], dtype=np.uint64)


def _meet(x: np.ndarray, bits: list[int], bucket: int, radius: int) -> Iterator[np.ndarray]:
    """Pairs (index of a fingerprint, index of the smallest that shares a point with it)
    over the points whose ``bits`` (lowest first) spell ``bucket``."""
    stack = [(np.arange(len(x)), list(bits), bucket)]
    while stack:
        idx, bits, bucket = stack.pop()
        must = np.zeros(len(idx), np.uint64)
        for k, b in enumerate(bits):
            must |= ((((x[idx] >> np.uint64(b)) & np.uint64(1)) ^ np.uint64((bucket >> k) & 1)) << np.uint64(b))
        need = np.bitwise_count(must)
        idx, must, need = idx[need <= radius], must[need <= radius], need[need <= radius]
        if len(idx) < 2:
            continue
        rest = [b for b in range(64) if b not in bits]
        count = [int((need == w).sum()) for w in range(radius + 1)]
        points = sum(c * sum(math.comb(len(rest), r) for r in range(radius - w + 1)) for w, c in enumerate(count))
        if points > POINTS and rest:
            b = rest[0]
            stack += [(idx, [*bits, b], bucket | v << len(bits)) for v in (0, 1)]
            continue
        vals, owners = [], []
        for w in range(radius + 1):
            own = idx[need == w]
            if len(own):
                masks = _flips(rest, radius - w)
                vals.append(((x[own] ^ must[need == w])[:, None] ^ masks[None, :]).ravel())
                owners.append((own, len(masks)))
        vals = np.concatenate(vals)
        s = np.sort(vals)
        twice = s[1:][s[1:] == s[:-1]]
        del s
        if not len(twice):
            continue
        twice = np.unique(twice)
        # a small bitmap first, then the exact look-up of what it lets through
        seen = np.zeros(1 << 20, bool)
        seen[(twice * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)] = True
        at = np.flatnonzero(seen[(vals * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)])
        which = np.searchsorted(twice, vals[at])
        hit = (which < len(twice)) & (twice[np.minimum(which, len(twice) - 1)] == vals[at])
        at, which = at[hit], which[hit]
        own = np.empty(len(at), np.int64)
        low = 0
        for ids, each in owners:
            inside = (at >= low) & (at < low + len(ids) * each)
            own[inside] = ids[(at[inside] - low) // each]
            low += len(ids) * each
        hub = np.full(len(twice), len(x), np.int64)
        np.minimum.at(hub, which, own)
        pairs = np.stack((own, hub[which]), axis=1)
        yield np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)


def _forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of n nodes."""
    label = np.arange(n)
    a, b = pairs[:, 0], pairs[:, 1]
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        label = new[label]
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


def _bucket_links(bits: list[int], max_bits: int):
    radius = max_bits // 2

    def run(t: pa.Table) -> pa.Table:
        x = np.unique(t.column("fp").to_numpy().view(np.uint64))  # sorted: the smallest index is the smallest value
        bucket = t.column("bucket")[0].as_py()
        found = np.zeros((0, 2), np.int64)
        for pairs in _meet(x, bits, bucket, radius):
            near = np.bitwise_count(x[pairs[:, 0]] ^ x[pairs[:, 1]]) <= max_bits
            found = np.concatenate((found, pairs[near]))
        label = _forest(len(x), found)
        u = np.flatnonzero(label != np.arange(len(x)))
        return pa.table({"u": pa.array(x[u].view(np.int64)), "v": pa.array(x[label[u]].view(np.int64))})

    return run


def near_components(spark: SparkSession, fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for the distinct long column ``fp``: fingerprints reachable over links of
    at most ``max_bits`` differing bits (an even number) share their root."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: the ball's radius is half of it")
    radius = max_bits // 2
    row = fps.agg(F.count(F.lit(1)), *[F.sum(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1)))
                                       for b in range(64)]).first()
    n = row[0]
    points = n * sum(math.comb(64, r) for r in range(radius + 1))
    width = max(8, math.ceil(math.log2(max(1, points / POINTS))))
    # the most even bits deal the points out best
    bits = sorted(range(64), key=lambda b: (abs(2 * (row[b + 1] or 0) - n), b))[:width]
    bucket = F.lit(0).cast("long")
    for k, b in enumerate(bits):
        bucket = bucket + F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1)), k)
    deltas = [int(m) for m in _flips(list(range(width)), radius)]
    sent = (fps.select("fp", bucket.alias("own"))
            .select("fp", F.explode(F.transform(F.array(*[F.lit(d).cast("long") for d in deltas]),
                                                lambda d: F.col("own").bitwiseXOR(d))).alias("bucket")))
    links = sent.groupBy("bucket").applyInArrow(_bucket_links(bits, max_bits), "u long, v long")
    roots = connected_components(links)
    return (fps.join(roots, fps.fp == roots.node, "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    narrow = written(spark, fingerprints(docs, shingle_words), "simhash-fp")
    fps = narrow.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = near_components(spark, fps.select("fp"), max_bits)
    by_fp = fps.join(roots, "fp")
    first = by_fp.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = by_fp.join(first, "root").select("fp", "component_id")
    return narrow.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_component(spark: SparkSession, docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                      max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each component: that with
    the smallest doc_id (nulls last), then the smallest row hash.  Of identical rows one stays."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.withColumn("__row", row)
    narrow = written(spark, fingerprints(marked, shingle_words, ("doc_id", "__row")), "simhash-rows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "__row")).alias("best")
    fps = narrow.groupBy("fp").agg(best)
    roots = near_components(spark, fps.select("fp"), max_bits)
    keep = (fps.join(roots, "fp").groupBy("root").agg(F.min("best").alias("best"))
            .select("root", "best.doc_id", "best.__row"))
    same = narrow.groupBy("doc_id", "__row").agg(F.count(F.lit(1)).alias("__n"))
    keep = keep.alias("k").join(same.alias("s"), F.expr("k.__row = s.__row AND k.doc_id <=> s.doc_id")).select(
        F.col("k.doc_id").alias("__id"), F.col("k.__row").alias("__key"), "__n")
    kept = marked.join(keep, (F.col("__row") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    single = kept.where("__n = 1").select(*docs.columns)
    if keep.where("__n > 1").isEmpty():
        return single
    return single.unionAll(kept.where("__n > 1").dropDuplicates(["__id", "__key"]).select(*docs.columns))


@register("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
