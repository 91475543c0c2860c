"""Token ids in wavelet-matrix files.

``write_shards`` sorts whole texts by doc_id (range partitions), encodes them with the
tokenizers library, appends the end id to each document, and writes files of about
``SHARD_TOKENS`` ids in that order into the shared folder, with a table of the files.
Each file holds a wavelet matrix: one bit-plane for each bit of an id, highest first; after a
plane the ids with a 0 go in front of those with a 1, in order.  Planes, rank samples and
document lengths are compressed in one file.  ``WaveletMatrix`` gives access, rank, count,
select and all occurrences of an id from it.

``read_shards`` opens the files with Spark's binary reader and undoes the planes from the
lowest to the highest, which restores all ids of a file at once; a document's place among
all ids is the sum of the files before it.

Pieces: the library's own pre-tokeniser pattern cuts a text, and a piece's ids do not depend on
its neighbours, so each distinct piece of a task is given to the library's model once.  A bounded
table keeps pieces.  Tests hold the ids of whole texts against ``Tokenizer.encode``.

Defined cases: null text is empty (the end id alone); null doc_ids come first; rows with equal
doc_ids are ordered by a hash of the text, equal rows in any order; a text longer than a
shard makes a file of its own; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import put_file, shared_dir, table, text_batches, written
from .op7_bpe import WHITE, byte_symbols, recent, vocabulary_path
from .registry import register

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 1_000_000
KEEP_PIECES = 600_000
#: Bits of a plane between two rank samples.
SAMPLE = 4096


def pieces(letter: str, number: str, white: str) -> str:
    """How the byte-level pre-tokeniser cuts texts, for the given character classes."""
    return (f" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{white}{letter}{number}]+"
            f"|[{white}]+(?![^{white}])|[{white}]+")


class PieceEncoder:
    """Texts to bytes of little-endian ids, piece by piece, through the tokenizers library: the
    library's model encodes each new piece, known ones are looked up."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        if spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False,
                                                           "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"unsupported vocabulary file {path}")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.pattern = regex.compile(pieces(r"\p{L}", r"\p{N}", WHITE))
        # the same for texts below U+0250, where the three classes are short lists
        near = {kind: "".join(f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == kind) for kind in "LN"}
        self.near = re.compile(pieces(near["L"], near["N"], WHITE))
        self.far = re.compile("[^\\u0000-\\u024f]")
        self.width = 2 if max(self.library.get_vocab().values()) < 1 << 16 else 4
        self.model = self.library.model
        self.symbols = dict(enumerate(byte_symbols()))
        self.known: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def cut(self, text: str) -> list[str]:
        if not self.far.search(text):
            return self.near.findall(text)
        if recent().search(text):  # newer than Python's Unicode tables
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def _plain(self, text: str) -> bytes:
        cut, known = self.cut(text), self.known
        for p in set(cut).difference(known):
            mapped = p.encode().decode("latin-1").translate(self.symbols)
            known[p] = self._bytes([t.id for t in self.model.tokenize(mapped)])
        return b"".join(map(known.__getitem__, cut))

    def encode(self, text: str) -> bytes:
        if len(self.known) > KEEP_PIECES:
            self.known = {}
        if "<" in text and self.special and self.split.search(text):
            return b"".join([self._bytes([self.special[part]]) if k % 2 else self._plain(part)
                             for k, part in enumerate(self.split.split(text))])
        return self._plain(text)


@functools.cache
def encoder(name: str) -> PieceEncoder:
    return PieceEncoder(vocabulary_path(name))


class WaveletMatrix:
    """Bit-planes with rank samples over a sequence of ids."""

    def __init__(self, n: int, planes: list, zeros: list, samples: list):
        self.n, self.planes, self.zeros, self.samples = n, planes, zeros, samples

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes, zeros, samples = [], [], []
        for b in range(bits - 1, -1, -1):
            on = (ids & ids.dtype.type(1 << b)) != 0
            ones, none = np.flatnonzero(on), np.flatnonzero(~on)
            plane = np.packbits(on, bitorder="little")
            plane = np.concatenate((plane, np.zeros(-len(plane) % (SAMPLE // 8), np.uint8)))
            per = np.bitwise_count(plane.view(np.uint64)).reshape(-1, SAMPLE // 64).sum(axis=1, dtype=np.uint64)
            planes.append(plane)
            zeros.append(len(none))
            samples.append((np.cumsum(per) - per).astype(np.uint32))
            ids = np.concatenate((ids.take(none), ids.take(ones)))
        return cls(len(ids), planes, zeros, samples)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        if i >= self.n:
            return self.n - self.zeros[level]
        block = i // SAMPLE
        part = np.unpackbits(self.planes[level][block * SAMPLE // 8:(i + 7) // 8], bitorder="little")
        return int(self.samples[level][block]) + int(part[:i - block * SAMPLE].sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, i)
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        bits = len(self.planes)
        if token < 0 or token >> bits:
            return 0, 0
        for level in range(bits):
            a, b = self._rank1(level, low), self._rank1(level, high)
            if token >> (bits - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often the id occurs at places low .. high - 1."""
        high = self.n if high is None else min(high, self.n)
        low, high = self._range(token, max(0, low), max(low, high))
        return high - low

    def rank(self, token: int, i: int) -> int:
        return self.count(token, 0, i)

    def _up(self, places: np.ndarray) -> np.ndarray:
        """Places of the last order as places of the sequence."""
        for level in range(len(self.planes) - 1, -1, -1):
            on = np.unpackbits(self.planes[level], bitorder="little", count=self.n)
            zeros = self.zeros[level]
            out = np.empty_like(places)
            high = places >= zeros
            if high.any():
                out[high] = np.flatnonzero(on)[places[high] - zeros]
            if not high.all():
                out[~high] = np.flatnonzero(on == 0)[places[~high]]
            places = out
        return places

    def occurrences(self, token: int) -> np.ndarray:
        """All places of the id, rising."""
        low, high = self._range(token, 0, self.n)
        return self._up(np.arange(low, high))

    def select(self, token: int, k: int) -> int:
        """The place of the id's k-th occurrence, from 0."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        return int(self._up(np.array([low + k]))[0])

    def decode(self) -> np.ndarray:
        """All ids, as unsigned integers."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for k, level in enumerate(range(len(self.planes) - 1, -1, -1)):
            on = np.unpackbits(self.planes[level], bitorder="little", count=self.n).view(bool)
            ids[self.zeros[level]:] |= kind(1 << k)
            order = np.concatenate((np.flatnonzero(~on), np.flatnonzero(on)))
            out = np.empty_like(ids)
            out[order] = ids
            ids = out
        return ids


HEAD = struct.Struct("<4sQQI")


def file_bytes(doc_ids: list, lengths: list, ids: np.ndarray) -> bytes:
    """The file of a shard: a header, then compressed blocks: which doc_ids are null, doc_ids,
    lengths, and for each plane its number of zeros, rank samples and bits."""
    w = WaveletMatrix.build(ids)
    c = zstandard.ZstdCompressor(level=1)
    blocks = [np.array([d is None for d in doc_ids], np.uint8), np.array([d or 0 for d in doc_ids], "<i8"),
              np.array(lengths, "<u8")]
    for plane, zeros, samples in zip(w.planes, w.zeros, w.samples):
        blocks += [np.array([zeros], "<u8"), samples.astype("<u4"), plane]
    packed = [c.compress(b.tobytes()) for b in blocks]
    return b"".join([HEAD.pack(b"WMX1", len(doc_ids), w.n, len(w.planes)),
                     struct.pack(f"<{len(packed)}Q", *map(len, packed)), *packed])


def parse_file(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    magic, n_docs, n, bits = HEAD.unpack_from(data)
    if magic != b"WMX1":
        raise ValueError("not a wavelet-matrix file")
    sizes = struct.unpack_from(f"<{3 + 3 * bits}Q", data, HEAD.size)
    at, blocks = HEAD.size + 8 * len(sizes), []
    for s in sizes:
        blocks.append(zstandard.decompress(data[at:at + s]) if s else b"")
        at += s
    null, doc_ids, lengths = (np.frombuffer(b, k) for b, k in zip(blocks, (np.uint8, "<i8", "<u8")))
    planes = [np.frombuffer(b, np.uint8) for b in blocks[5::3]]
    zeros = [int(np.frombuffer(b, "<u8")[0]) for b in blocks[3::3]]
    samples = [np.frombuffer(b, "<u4") for b in blocks[4::3]]
    ids = [None if x else d for x, d in zip(null.tolist(), doc_ids.tolist())]
    return ids, lengths, WaveletMatrix(n, planes, zeros, samples)


def write_shards(spark: SparkSession, docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> tuple[str, DataFrame]:
    """Writes the files; returns their folder and the table of files (name, n_docs, n_tokens,
    start: ids in all files before)."""
    folder = shared_dir(spark, "token-shards")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t"),
                       F.xxhash64("text").alias("h"))
    rows = (rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "h")
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h").select("doc_id", "t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, files = encoder(vocabulary), TaskContext.get().partitionId(), 0
        kind = f"<u{e.width}"
        end = np.array([end_id], kind).tobytes()
        ids, lengths, data, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, lengths, data, size, files
            name = f"{part:07d}-{files:06d}.wm"
            tokens = np.frombuffer(b"".join(data), kind)
            put_file(f"{folder}/{name}", file_bytes(ids, lengths, tokens))
            out = pa.RecordBatch.from_pydict({"name": [name], "n_docs": [len(ids)], "n_tokens": [size]})
            ids, lengths, data, size, files = [], [], [], 0, files + 1
            return out

        for batch, texts in text_batches(batches, 1, max_bytes=2 << 20):
            for d, x in zip(batch.column(0).to_pylist(), [e.encode((t or b"").decode("utf-8", "replace")) for t in texts]):
                ids.append(d)
                lengths.append(len(x) // e.width + 1)
                data += [x, end]
                size += lengths[-1]
                if size >= shard_tokens:
                    yield close()
        if ids:
            yield close()

    files = written(spark, rows.mapInArrow(run, "name string, n_docs long, n_tokens long"), "token-files")
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return folder, files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                doc_ids, lengths, w = parse_file(content.as_buffer().to_pybytes())
                ids = w.decode().astype("<u4", copy=False)
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths.astype(np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([name.as_py()] * len(doc_ids), pa.string()), pa.array(doc_ids, pa.int64()), pa.array(starts),
                    pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())], names=["name", "doc_id", "place", "n_tokens", "crc"])

    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    content = (spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folder)
               .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    docs = content.mapInArrow(run, "name string, doc_id long, place long, n_tokens long, crc long")
    return docs.join(files.select("name", F.col("start").alias("base")), "name").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))


@register("op6_wavelet_tokens")
def op6_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(spark, *write_shards(spark, table(spark, sf_dir, "documents")))
