"""Phrase collocations from one FM-index per shard over word ids.

1. ``build``: tasks turn their documents into a stream of word ids, language by language, with separators between
   pieces and documents.  Every ``SHARD_WORDS`` ids become a shard: suffixes sorted by their first
   ``MAX_WORDS`` words (enough for phrases of that length), the words before them as the BWT, one
   compressed file in the shared folder.
2. Rounds 1 to ``MAX_WORDS``.  Round 1 lists a shard's words; later rounds extend the intervals of
   frequent phrases by one word: to the left by a step through the BWT (the words before an
   interval's suffixes, each with its new interval), to the right by nesting: a longer phrase's
   interval lies inside that of its beginning, so extensions whose beginning ended in an earlier
   round are cut off on the spot.  One order thus serves both directions.  As a longer phrase's rows all lie in
   those intervals, from round 3 on a shard keeps and reads only the rows of its frequent phrases.  Counts are summed over
   shards; phrases below ``min_count`` end there, since no longer phrase can have more.
   Frequent words and phrases have numbers.  A word's key is its language and itself; a longer phrase's
   is the number of its first word and that of the rest, exactly, in 64 bits.  A shard sends its keys and counts sorted and packed, a
   row for each part of the keys, and gets back for each part which of its keys are frequent and their
   numbers; it keeps the intervals itself in a file.  Only phrases known to be frequent are spelled out
   as rows.  So what moves after the words is a few bytes for a phrase of a shard, at most as many phrases
   as the shard has words, in each round.
   Before that, counts are summed over shards by hash bucket: a bucket below ``min_count`` holds no
   frequent phrase, so the many rare extensions end there.  There is a bucket for every 16 to 32 words,
   ``MOST_BUCKETS`` at most (beyond that the filter lets more through; the result stays the same).
3. Scores.  A candidate's cuts look up the counts of both parts, all of which are frequent too; a
   candidate goes if an extension by one word, left or right, is as frequent (any longer phrase
   that is as frequent contains such an extension).

Nothing is ever held for a whole language: shards are bounded, counts meet by phrase, and per
language only a total and the report's first ``top`` rows exist.  Shards are named by the task
attempt that wrote them, and the rows of that attempt alone refer to them.

A-Z are lower-cased; pieces are split at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+``.  Defined
cases: null texts are empty, a null lang is ``und``; empty texts have no words; repeated rows count
each; a piece longer than a shard stays whole; ties go to higher count, then to the phrase in byte
order; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import get_file, put_file, shared_dir, shuffles_removed, table, text_batches, written
from .registry import register

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: Ids of a shard.
SHARD_WORDS = 8_000_000
#: Bits of the number of hash buckets, at most and within one file; shards whose counts one task sums first.
MOST_BUCKETS = 28
PART_BITS = 20
SUMMED_SHARDS = 256
#: Words of the input for each part of the phrase keys, which one task sums.
PART_WORDS = 1 << 22
WORDS = "g long, lang string, phrase string, f long"
FREQUENT = "g long, word long, rest long, f long"
COUNTS = "part int, shard long, places binary, counts binary"
_BASE = np.uint64(0x9E3779B97F4A7C15)

_SEPARATORS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The words of the texts and, between pieces and after each text, b"\\n": the bytes of all, and where each begins."""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower().translate(_SEPARATORS), np.uint8)
    word, cut = data != 32, data == 10
    begins = cut.copy()
    begins[0] = word[0]
    begins[1:] |= word[1:] & ~(word[:-1] & ~cut[:-1])
    return data[word], np.flatnonzero(begins[word])


def _numbered(parts: list, first: int) -> tuple[np.ndarray, pa.Array]:
    """Ids of tokens, which are words of one language from id ``first`` on or separators (0), and the words in order of their ids."""
    at = np.cumsum([0, *(len(data) for data, _ in parts)])
    begins = np.concatenate([*(b + x for (_, b), x in zip(parts, at.tolist())), at[-1:]])
    data = np.concatenate([data for data, _ in parts])
    coded = pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(data)]).dictionary_encode()
    cut = pc.index(coded.dictionary, pa.scalar(b"\n", pa.large_binary())).as_py()
    ids = np.arange(first, first + len(coded.dictionary), dtype=np.int32)
    ids[cut + 1:] -= 1
    ids[cut] = 0
    return ids[coded.indices.to_numpy()], pa.concat_arrays([coded.dictionary[:cut], coded.dictionary[cut + 1:]])


def _order(x: np.ndarray) -> np.ndarray:
    """Places of the numbers from 0 on in rising order, equal ones as they stand."""
    bits = len(x).bit_length()
    if int(x.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(x, kind="stable").astype(np.int32)
    both = x.astype(np.int64)
    both <<= bits
    both |= np.arange(len(x))
    both.sort()  # plain numbers sort several times faster than places
    both &= (1 << bits) - 1
    return both.astype(np.int32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rows:
    """Rows of sorted suffixes.  ``first`` and ``n`` are runs of their first ids, ``shorter`` is the row of the suffix
    one word shorter, of every row; the number of rows if that is not among them."""

    def __init__(self, shorter: np.ndarray, first: np.ndarray, n: np.ndarray):
        self.shorter, self.first, self.n = shorter, first, n

    def at(self, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which of the disjoint intervals, sorted by ``lo``, each row lies in, or -1; and a last -1."""
        rows, which = int(self.n.sum()), np.full(2 * len(lo) + 1, -1, np.int32)
        which[1::2] = np.arange(len(lo))
        runs = np.empty(len(which), np.int64)
        runs[1::2], runs[::2] = size, np.diff(np.concatenate([lo, [rows + 1]]), prepend=0) - np.concatenate([[0], size])
        return np.repeat(which, runs)

    def extended(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, id before it, new lo, new size) of all extensions to the left of disjoint
        intervals sorted by ``lo`` whose beginning also lies in one of these intervals; sorted by new lo."""
        at, ends = self.at(lo, size), int(self.n[:1].sum()) if len(self.n) and self.first[0] == 0 else 0
        # rows stand in the order of their first id and, with that, of the suffixes one word shorter
        which = at[self.shorter[ends:]]
        new = np.flatnonzero((which >= 0) & (at[ends:-1] >= 0))
        which, first = which[new], np.repeat(self.first, self.n)[ends:][new]
        begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(new)), bool), (which[1:] != which[:-1]) | (first[1:] != first[:-1])]))
        return which[begins].astype(np.int64), first[begins], new[begins] + ends, np.diff(begins, append=len(new)).astype(np.int32)

    def narrowed(self, lo: np.ndarray, size: np.ndarray) -> Rows:
        """The rows of disjoint intervals of phrases alone, sorted by ``lo``: all that longer phrases ask for."""
        rows = np.flatnonzero(self.at(lo, size)[:-1] >= 0)
        new = np.full(int(self.n.sum()) + 1, len(rows), np.int32)
        new[rows] = np.arange(len(rows))
        return Rows(new[self.shorter[rows]], self.first[np.searchsorted(np.cumsum(self.n), lo, "right")], size)


class FMIndex(Rows):
    """BWT of a sequence of ids (0 separates) whose suffixes are sorted by ``MAX_WORDS`` ids.
    ``words`` has columns lang and word, row i for id i."""

    def __init__(self, bwt: np.ndarray, words: pa.Table):
        self.bwt, self.words = bwt, words

    @cached_property
    def shorter(self) -> np.ndarray:
        return _order(self.bwt)

    @cached_property
    def n(self) -> np.ndarray:
        return np.bincount(self.bwt, minlength=self.words.num_rows)

    @cached_property
    def first(self) -> np.ndarray:
        return np.arange(len(self.n))

    @staticmethod
    def transform(ids: np.ndarray) -> np.ndarray:
        """The BWT: order by 2 ids, by pairs of their ranks, then by MAX_WORDS = 4 + 1; the first id follows the last."""
        def before(order: np.ndarray, step: int, by: np.ndarray) -> np.ndarray:
            order = order - step
            order[order < 0] += len(order)
            return order[_order(by[order])]

        pairs = ids.astype(np.int64) * (int(ids.max(initial=0)) + 1) + np.roll(ids, -1)
        order = _order(pairs)
        pairs = pairs[order]
        rank = np.empty(len(ids), np.int32)
        rank[order] = np.cumsum(np.concatenate([[False], pairs[1:] != pairs[:-1]]))
        return ids[before(before(order, 2, rank), 1, ids) - 1]

    def ids(self, lo: np.ndarray, k: int) -> list:
        """The ids of the phrases of ``k`` words whose intervals begin at ``lo``, word by word."""
        out, row = [], lo
        for _ in range(k):
            row = self.shorter[row]
            out.append(self.bwt[row])
        return out

    def keys(self) -> pa.Array:
        """Lang, a tab and the word of every id; no word holds a tab."""
        return pc.binary_join_element_wise(self.words.column("lang"), self.words.column("word"), pa.scalar(b"\t", pa.large_binary())).combine_chunks()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of lang and word of every id, equal in all shards."""
        both = self.keys()
        data, at = np.frombuffer(both.buffers()[2], np.uint8), np.frombuffer(both.buffers()[1], np.int64)[:len(both) + 1]
        place = np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE, np.uint64))
        return _mix(np.add.reduceat((data[:at[-1]] + np.uint64(1)) * powers[place], at[:-1]))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        with pa.ipc.new_file(out, self.words.schema) as f:
            f.write_table(self.words)
        press = zstandard.ZstdCompressor(level=3).compress
        # the four bytes of the ids one after the other: high bytes are nearly all zero
        planes = press(np.ascontiguousarray(self.bwt.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())
        return len(planes).to_bytes(8, "little") + planes + press(out.getvalue())

    @classmethod
    def from_bytes(cls, data: bytes) -> FMIndex:
        n = int.from_bytes(data[:8], "little")
        unpress = zstandard.ZstdDecompressor().decompress
        planes = np.frombuffer(unpress(data[8:8 + n]), np.uint8).reshape(4, -1)
        bwt = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int32)
        return cls(bwt, pa.ipc.open_file(io.BytesIO(unpress(data[8 + n:]))).read_all())


def _build(folder: str, shard_words: int):
    """Writes the shards of a task's documents; returns shard, lang and n (words of the language)."""

    def flush(made: int, known: dict) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().taskAttemptId() << 20 | made
        ids, langs, words, ends = [np.zeros(1, np.int32)], [], [], [1]
        while known:
            lang, parts = known.popitem()
            own, of = _numbered(parts, ends[-1])
            ids.append(own)
            if len(of):
                langs.append(lang)
                words.append(of)
                ends.append(ends[-1] + len(of))
        if not langs:
            return
        bwt = FMIndex.transform(np.concatenate(ids))
        empty, lang = pa.array([b""], pa.large_binary()), pa.array([x.encode() for x in langs], pa.large_binary())
        table = pa.table({"lang": pa.concat_arrays([empty, lang.take(pa.array(np.repeat(np.arange(len(langs)), np.diff(ends))))]),
                          "word": pa.concat_arrays([empty, *words])})
        put_file(f"{folder}/{shard:016x}.fmi", FMIndex(bwt, table).to_bytes())
        n = np.add.reduceat(np.bincount(bwt, minlength=ends[-1]), ends[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([shard] * len(n), pa.int64()), pa.array(langs, pa.string()), pa.array(n, pa.int64())],
                                         names=["shard", "lang", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size, words, known = 0, 0, False, {}
        for batch, texts in text_batches(batches, 1, max_bytes=min(4 << 20, shard_words)):
            of: dict = {}
            for lang, t in zip(batch.column(0).to_pylist(), texts):
                of.setdefault(lang, []).append(t)
            for lang, own in of.items():
                data, begins = tokens(own)
                known.setdefault(lang, []).append((data, begins))
                size += len(begins)
                words = words or bool((data != 10).any())
            if size >= shard_words and words:
                yield from flush(made, known)
                made, size, words, known = made + 1, 0, False, {}
        yield from flush(made, known)

    return run


def _sparse(dense: np.ndarray, part: int, shard: int) -> dict:
    """A row of COUNTS from the buckets of a part that are not empty."""
    return _packed(np.flatnonzero(dense), dense[dense > 0], part, shard)


def _press(x: np.ndarray, kind: str = "<u4") -> bytes:
    """The bytes of the numbers one after the other: high bytes are nearly all zero."""
    kind = np.dtype(kind)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T).tobytes())


def _unpress(data: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64)


def _packed(places: np.ndarray, counts: np.ndarray, part: int, shard: int | None, kind: str = "<u4") -> dict:
    return {"part": part, "shard": shard, "places": _press(np.diff(places, prepend=0), kind), "counts": _press(counts, kind)}


def _packed_words(keys: pa.Array, counts: np.ndarray, part: int, shard: int | None) -> dict:
    out, words = io.BytesIO(), pa.table({"key": keys})
    with pa.ipc.new_file(out, words.schema) as f:
        f.write_table(words)
    return {"part": part, "shard": shard, "places": zstandard.ZstdCompressor(level=3).compress(out.getvalue()), "counts": _press(counts, "<u8")}


def _words(data: bytes) -> pa.Array:
    return pa.ipc.open_file(io.BytesIO(zstandard.ZstdDecompressor().decompress(data))).read_all().column("key").combine_chunks()


def _store(path: str, *columns: np.ndarray) -> None:
    put_file(path, _press(np.concatenate(columns).astype(np.int64), "<u8"))


def _load(path: str, n: int) -> np.ndarray:
    return _unpress(get_file(path), "<u8").reshape(n, -1)


def _rows(rows: list) -> pa.Table:
    return pa.table({"part": pa.array([r["part"] for r in rows], pa.int32()), "shard": pa.array([r["shard"] for r in rows], pa.int64()),
                     "places": pa.array([r["places"] for r in rows], pa.binary()), "counts": pa.array([r["counts"] for r in rows], pa.binary())})


def _salt(salts: int) -> Column:
    """Deals the shards; their names end in zeros, so the name's hash says where."""
    return F.pmod(F.xxhash64("shard"), F.lit(salts))


def _summed(bits: int, min_count: int, folder: str | None = None):
    """Sums the counts of each part (rows sorted by part); with a folder, writes a bit for every
    bucket that reaches ``min_count`` instead of returning the sums."""
    size = 1 << min(bits, PART_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, shard = None, None, 0

        def done() -> Iterator[pa.RecordBatch]:
            if at is None:
                return
            if folder:
                put_file(f"{folder}/{at:06d}.bits", np.packbits(total >= min_count).tobytes())
            yield from _rows([_sparse(total, at, shard)] if not folder else []).to_batches()

        for batch in batches:
            for part, shard_, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part != at:
                    yield from done()
                    at, total, shard = part, np.zeros(size, np.uint32), shard_
                where = np.cumsum(_unpress(places))
                total[where] = np.minimum(total[where] + _unpress(counts), min_count)
        yield from done()

    return run


def _frequent(folder: str, k: int, t: pa.Table) -> np.ndarray:
    """lo, size and number of a shard's frequent phrases of ``k`` words, by lo, from the answers to the keys sent."""
    shard, parts = t.column("shard")[0].as_py(), t.column("parts")[0].as_py()
    part, lo, size = _load(f"{folder}/{shard:016x}-{k}.nodes", 3)
    rows, numbers = [], []
    for at, mask, ranks in zip(*(t.column(c).to_pylist() for c in ("part", "places", "counts"))):
        first, end = np.searchsorted(part, [at, at + 1])
        mask = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(mask), np.uint8), count=int(end - first))
        rows.append(first + np.flatnonzero(mask))
        numbers.append(np.cumsum(_unpress(ranks)) * parts + at)
    rows = np.concatenate(rows)
    out = np.stack([lo[rows], size[rows], np.concatenate(numbers)])
    return out[:, np.argsort(out[0])]


def _known(folder: str, k: int, t: pa.Table, first: bool) -> tuple[Rows, np.ndarray]:
    """A shard's rows for round ``k`` and lo, size and number of its frequent phrases of k - 1 words.  The first task
    of a round makes them from the answers; from round 3 on only rows of frequent phrases are kept."""
    shard = t.column("shard")[0].as_py()
    path, whole = f"{folder}/{shard:016x}", FMIndex.from_bytes(get_file(f"{folder}/{shard:016x}.fmi")) if k == 2 or k == 3 and first else None
    if not first:
        known = _load(f"{path}-{k - 1}.frequent", 3)
        return whole or Rows(*_load_rows(f"{path}-{k - 1}")), known
    known = _frequent(folder, k - 1, t)
    rows = whole or Rows(*_load_rows(f"{path}-{k - 2}"))
    if k == 2:
        by_id = np.full(len(rows.n), -1)
        by_id[rows.ids(known[0], 1)[0]] = known[2]
        _store(f"{path}.numbers", by_id)
    else:
        rows = rows.narrowed(known[0], known[1])
        known[0] = np.cumsum(known[1]) - known[1]
        put_file(f"{path}-{k - 1}.shorter", _press(rows.shorter))
        _store(f"{path}-{k - 1}.first", rows.first, rows.n)
    _store(f"{path}-{k - 1}.frequent", *known)
    return rows, known


def _load_rows(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first, n = _load(f"{path}.first", 2)
    return _unpress(get_file(f"{path}.shorter")), first, n


def _round(folder: str, k: int, bits: int, min_count: int, space: int, filters: str | None = None, parts: int = 1):
    """Phrases of ``k`` words of a shard from its frequent ones of k - 1 words, whose numbers are below ``space``:
    their counts by bucket, or with ``filters`` keys and counts of those whose bucket reaches ``min_count``, in
    ``parts`` parts."""

    def run(t: pa.Table) -> pa.Table:
        shard = t.column("shard")[0].as_py()
        if k == 1:
            index = FMIndex.from_bytes(get_file(f"{folder}/{shard:016x}.fmi"))
            n = index.n
            lo, size, ids = (np.cumsum(n) - n)[1:], n[1:], np.arange(1, len(n))
            hashes = index.hashes()[1:]
        else:
            rows, known = _known(folder, k, t, filters is None)
            which, before, lo, size = rows.extended(known[0], known[1])
            key = _load(f"{folder}/{shard:016x}.numbers", 1)[0][before] * space + known[2][which]
            hashes = _mix(key.astype(np.uint64) + _BASE)
        bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        if filters is None:
            order = np.argsort(bucket)
            sorted_ = bucket[order]
            first = np.flatnonzero(np.diff(sorted_, prepend=-1))
            sums = np.minimum(np.add.reduceat(size[order].astype(np.int64), first), min_count) if len(first) else np.zeros(0, np.int64)
            places, part = sorted_[first], sorted_[first] >> PART_BITS
            cuts = np.flatnonzero(np.diff(part)) + 1
            return _rows([_packed(p & ((1 << PART_BITS) - 1), c, int(p[0]) >> PART_BITS, shard)
                          for p, c in zip(np.split(places, cuts), np.split(sums, cuts)) if len(p)])
        # a bit for every bucket: 1 << MOST_BUCKETS bits at most
        size_, on = 1 << min(bits, PART_BITS), np.zeros(1 << bits >> 3, np.uint8)
        for part in np.unique(bucket >> PART_BITS).tolist():
            on[part * size_ >> 3:(part + 1) * size_ >> 3] = np.frombuffer(get_file(f"{filters}/{part:06d}.bits"), np.uint8)
        keep = on[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1 == 1
        lo, size = lo[keep], size[keep]
        if k == 1:
            key, part = index.keys().take(pa.array(ids[keep])), (hashes[keep] % np.uint64(parts)).astype(np.int64)
            order = pc.sort_indices(pa.table({"part": part, "key": key}), sort_keys=[("part", "ascending"), ("key", "ascending")]).to_numpy()
            key, part, lo, size = key.take(pa.array(order)), part[order], lo[order], size[order]
            _store(f"{folder}/{shard:016x}-{k}.nodes", part, lo, size)
            at = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
            return _rows([_packed_words(key.slice(a, b - a), size[a:b], int(part[a]), shard) for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
        place, part = np.divmod(key[keep], parts)
        order = np.lexsort((place, part))
        place, part, lo, size = place[order], part[order], lo[order], size[order]
        _store(f"{folder}/{shard:016x}-{k}.nodes", part, lo, size)
        cuts = np.flatnonzero(np.diff(part)) + 1
        return _rows([_packed(p, c, int(at[0]), shard, "<u8")
                      for p, c, at in zip(np.split(place, cuts), np.split(size, cuts), np.split(part, cuts)) if len(p)])

    return run


def _answers(min_count: int, words: bool = False):
    """Sums the counts of a part's keys over shards.  For each shard: which of its keys are frequent, and the gaps
    of their ranks among the part's frequent keys; and without a shard, the frequent keys and their counts."""

    def run(t: pa.Table) -> pa.Table:
        part, shards = t.column("part")[0].as_py(), t.column("shard").to_pylist()
        places = [_words(x) if words else np.cumsum(_unpress(x, "<u8")) for x in t.column("places").to_pylist()]
        counts = np.concatenate([_unpress(x, "<u8") for x in t.column("counts").to_pylist()])
        if words:
            coded = pa.concat_arrays(places).dictionary_encode()
            order = pc.sort_indices(coded.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            keys, where = coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]
        else:
            keys, where = np.unique(np.concatenate(places), return_inverse=True)
        f = np.zeros(len(keys), np.int64)
        np.add.at(f, where, counts)
        frequent = f >= min_count
        rank = np.cumsum(frequent) - 1
        out = []
        if frequent.any():
            out.append(_packed_words(keys.filter(pa.array(frequent)), f[frequent], part, None) if words
                       else _packed(keys[frequent], f[frequent], part, None, "<u8"))
        for shard, own in zip(shards, np.split(where, np.cumsum([len(p) for p in places])[:-1])):
            mask = frequent[own]
            if mask.any():
                out.append({"part": part, "shard": shard, "places": zstandard.ZstdCompressor(level=3).compress(np.packbits(mask).tobytes()),
                            "counts": _press(np.diff(rank[own[mask]], prepend=0))})
        return _rows(out)

    return run


def _unpacked_words(parts: int):
    """Frequent words as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                both = pc.split_pattern(_words(places), b"\t", max_splits=1, reverse=True)
                lang, word = (pc.list_element(both, i).cast(pa.large_string()).cast(pa.string()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lang)) * parts + part), lang, word, pa.array(_unpress(counts, "<u8"))],
                                                 names=["g", "lang", "phrase", "f"])

    return run


def _unpacked(space: int, parts: int):
    """Frequent keys as rows: the phrase's number, those of its first word and of the rest, its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                key = np.cumsum(_unpress(places, "<u8")) * parts + part
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.arange(len(key)) * parts + part, key // space, key % space, _unpress(counts, "<u8"))],
                                                 names=["g", "word", "rest", "f"])

    return run


def counted_phrases(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT,
                    shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of 1 to MAX_WORDS words found ``min_count`` times or more
    in their language, and (lang, n), the word occurrences of each."""
    folder = shared_dir(spark, "phrase-index")
    text = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    with shuffles_removed(spark):
        state = written(spark, text.mapInArrow(_build(folder, shard_words), "shard long, lang string, n long"), "phrase-shards")
        n = state.groupBy("lang").agg(F.sum("n").alias("n"))
        totals = state.agg(F.sum("n"), F.countDistinct("shard")).first()
        total = int(totals[0] or 0)
        bits = min(MOST_BUCKETS, max(8, total.bit_length() - 5))
        salts = -(-max(1, totals[1]) // SUMMED_SHARDS)
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # a shard's work is far larger than its rows: as many tasks as shards and parts, not as bytes ask for
        tasks, summing = max(1, min(most, totals[1])), max(1, min(most, 1 << max(0, bits - PART_BITS)))
        found = words = shorter = None
        space, parts = 1, 1
        for k in range(1, MAX_WORDS + 1):
            filters = shared_dir(spark, f"phrase-buckets-{k}")
            sums = state.repartition(tasks, "shard").groupBy("shard").applyInArrow(_round(folder, k, bits, min_count, space), COUNTS)
            if salts > 1:
                sums = sums.withColumn("salt", _salt(salts)).repartition(min(most, summing * salts), "part", "salt").drop("salt")
                sums = sums.sortWithinPartitions("part").mapInArrow(_summed(bits, min_count), COUNTS)
            sums.repartition(summing, "part").sortWithinPartitions("part").mapInArrow(_summed(bits, min_count, filters), COUNTS).count()
            shards = state.select("shard").distinct().repartition(tasks, "shard").groupBy("shard")
            parts = -(-max(1, total) // PART_WORDS)
            while math.gcd(parts, space) > 1:  # else a part may hold all phrases with the same end
                parts += 1
            keys = shards.applyInArrow(_round(folder, k, bits, min_count, space, filters, parts), COUNTS)
            answers = keys.repartition(min(most, parts), "part").groupBy("part").applyInArrow(_answers(min_count, k == 1), COUNTS)
            answers = written(spark, answers, f"phrase-answers-{k}")
            state = answers.where("shard IS NOT NULL").withColumn("parts", F.lit(parts))
            counts = answers.where("shard IS NULL").select("part", "places", "counts")
            if k == 1:
                counts = counts.mapInArrow(_unpacked_words(parts), WORDS)
            else:
                counts = (counts.mapInArrow(_unpacked(space, parts), FREQUENT)
                          .join(words.select(F.col("g").alias("word"), "lang", F.col("phrase").alias("first")), "word")
                          .join(shorter.select(F.col("g").alias("rest"), F.col("phrase").alias("later")), "rest")
                          .select("g", "lang", F.concat_ws(" ", "first", "later").alias("phrase"), "f"))
            counts = written(spark, counts, f"phrase-counts-{k}")
            words = counts if k == 1 else words
            rows = counts.select("lang", "phrase", F.lit(k).alias("k"), "f")
            found = rows if found is None else found.unionAll(rows)
            shorter, space = counts, (counts.agg(F.max("g")).first()[0] or 0) + 1
            first = space if k == 1 else first
            if first * space >= 1 << 63:
                raise ValueError("too many frequent phrases for 64-bit keys")
    return found, n


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("w", first, length), " ")


def collocations(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language."""
    found, n = counted_phrases(spark, docs, min_count, shard_words)
    candidates = found.where("k >= 2").withColumn("w", F.split("phrase", " "))
    around = candidates.select("lang", "f", F.explode(F.array(_part(F.lit(1), F.col("k") - 1), _part(F.lit(2), F.col("k") - 1))).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = candidates.join(around, ["lang", "phrase"], "left").where(F.coalesce("longer", F.lit(0)) < F.col("f"))
    cut = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut", _part(F.lit(1), F.col("cut")).alias("first"),
        _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    f = found.select("lang", "phrase", "f")
    cut = (cut.join(f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
           .join(f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
           .join(n, "lang"))
    big = [F.col(c).cast(f"decimal({d},0)") for c, d in (("a", 15), ("n", 18), ("l", 18), ("r", 18))]
    cut = cut.withColumn("over", F.lit(1000).cast("decimal(4,0)") * big[0] * big[1]).withColumn("under", big[2] * big[3])
    best = (cut.withColumn("score", F.expr("over div under").cast("long"))
            .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score").withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
q AS (SELECT lang, list_filter(regexp_split_to_array(s, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM q, range(1, 6) AS t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a, lang || chr(9) || phrase AS key FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 100),
x AS (SELECT c.lang, c.phrase, c.a, c.k, j, c.lang || chr(9) || array_to_string(w[1:j], ' ') AS h,
             c.lang || chr(9) || array_to_string(w[j + 1:], ' ') AS e
      FROM c, range(1, 5) AS t(j) WHERE j < c.k),
o AS (SELECT key, a FROM f WHERE a >= 100),
y AS (SELECT x.*, l.a AS l, r.a AS r FROM x JOIN o l ON l.key = x.h JOIN o r ON r.key = x.e),
s AS (SELECT y.*, n.n, CAST(1000::HUGEINT * y.a * n.n // (y.l::HUGEINT * y.r) AS BIGINT) AS score FROM y JOIN n ON n.lang = y.lang),
z AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
u AS (SELECT * FROM z WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = z.lang AND c.k > z.k AND 100 * c.a >= 100 * z.a
                                        AND contains(' ' || c.phrase || ' ', ' ' || z.phrase || ' ')))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase,
       a, l, r, CAST(n AS BIGINT) AS n, score
FROM u QUALIFY rank <= 2000
"""


@register("op12_phrase_collocations", ORACLE)
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, table(spark, sf_dir, "documents"))
