"""BPE encoding and decoding by dynamic programming over prefixes.

A word's encoding is fixed by one fact for each of its prefixes: the last token of the
prefix's encoding.  That token is unique.  It is the one among the tokens ending there
(found by an automaton with suffix links over all token strings) that fits the last token
of the prefix in front of it; two tokens fit if no merge would have joined symbols across
their border before both were whole.  Following the last tokens back from the end gives the
exact ids, without running merges.

Words are cut and normalised as the vocabulary file says (NFC, lower case, white space
dropped, special tokens first); texts with code points that are newer than Python's Unicode
tables are cut by the library.  No word reaches across white space, so texts are split there
and only what is not all letters, or letters before ASCII punctuation, meets the pattern.  Each
distinct word of a task is encoded once; a bounded table keeps encoded words.  Texts stay where
Spark reads them; nothing is shuffled.

The vocabulary is a parameter: a file that every executor can open, or the name of a file of
the installed ``public_tokenizers``.  Supported files: BPE with one merge for each token,
byte-level symbols and an optional end-of-word suffix, NFC and lower-case normalisers, a
splitting pattern, no decoder (tokens joined by spaces); others raise ValueError.

Defined cases: null text is empty (no ids); empty text has no ids and decodes to the empty
string; special-token strings inside texts become their ids, as the library does; repeated
rows are each returned; other columns are ignored by ``encoded``.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import string
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, text_batches
from .registry import register

VOCABULARY = "word_bpe_49k.json"
#: Encoded words (and their characters), and checked token pairs, that a task keeps.
KEEP_WORDS = 500_000
KEEP_CHARS = 8_000_000
KEEP_PAIRS = 500_000

# fixed values: white space as the tokenizers library's patterns know it
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
WHITE = "".join(f"\\u{c:04x}" for c in WHITE_SPACE)
#: White space to ``str.split``, but not to the library.
SPLIT_ONLY = "\x1c\x1d\x1e\x1f"


def vocabulary_path(name: str) -> str:
    if os.path.exists(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.cache
def recent() -> regex.Pattern:
    """Finds code points that Python and the regex module class differently: their Unicode
    versions differ there, so what the library knows of them is asked of the library."""
    kinds = (("L", r"\p{L}"), ("N", r"\p{N}"), ("Cn", r"\p{Cn}"))
    spans: list[list[int]] = []
    for plane in range(17):
        points = [c for c in range(plane << 16, (plane + 1) << 16) if not 0xD800 <= c < 0xE000]
        text = "".join(map(chr, points))
        newer = {ch: kind for kind, p in kinds for ch in regex.findall(p, text)}
        for ch in text:
            kind = unicodedata.category(ch)
            if newer.get(ch, "") != (kind if kind == "Cn" else kind[0] if kind[0] in "LN" else ""):
                if spans and spans[-1][1] == ord(ch) - 1:
                    spans[-1][1] += 1
                else:
                    spans.append([ord(ch), ord(ch)])
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]")


@functools.cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable Latin-1, else the next free character from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class Bpe:
    """Merge ranks, the automaton over token strings, and the last-token table."""

    #: Added to a symbol's code point where it ends a word.
    END = 0x200

    def __init__(self, vocab: dict, merges: list, suffix: str | None):
        self.suffix = suffix or ""
        self.ids = vocab
        self.strings = {i: t for t, i in vocab.items()}
        self.rank, self.left, self.right, self.pair_rank = {}, {}, {}, {}
        symbols: dict[int, str] = {}
        for s in byte_symbols():
            symbols[vocab[s]] = s
            if suffix:
                symbols[vocab[s + suffix]] = chr(ord(s) + self.END)
        for r, (a, b) in enumerate(merges):
            a, b, t = vocab[a], vocab[b], vocab[a + b]
            if t in symbols or a not in symbols or b not in symbols:
                raise ValueError("the vocabulary needs one merge for each token, after those of its parts")
            self.rank[t], self.left[t], self.right[t], self.pair_rank[a << 32 | b] = r, a, b, r
            symbols[t] = symbols[a] + symbols[b]
        self.base = -1
        self.automaton = ahocorasick.Automaton()
        whole: set = set()
        for t, s in symbols.items():  # merged tokens come after their parts
            if t not in self.rank or (self.left[t] in whole and self.right[t] in whole
                                      and self._apart(self.left[t], self.right[t], self.rank[t])):
                whole.add(t)  # a token that its own string encodes to
                self.automaton.add_word(s, (t, len(s), {}))
        self.automaton.make_automaton()
        self._fresh_pairs()

    def _fresh_pairs(self) -> None:
        """For each token, as far as known, whether it fits a token before it; -2 is a word's start, -1 a gap."""
        self.pairs = 0
        for _, _, fits in self.automaton.values():
            fits.clear()
            fits[-2], fits[-1] = True, False

    def _apart(self, l: int, r: int, limit: float) -> bool:
        """No merge of rank below ``limit`` joins symbols across the border of l and r: undo
        the later-made of the two again and again, and look for a merge in between."""
        rank = self.rank
        while True:
            found = self.pair_rank.get(l << 32 | r)
            if found is not None and found < limit:
                return False
            made_l, made_r = rank.get(l, -1), rank.get(r, -1)
            if made_l < 0 and made_r < 0:
                return True
            if made_l > made_r:  # of equal pairs the left one merges first
                limit, l = made_l, self.right[l]
            else:
                limit, r = made_r + 1, self.left[r]

    def symbols_of(self, word: str) -> str:
        if not (word.isascii() and word.isprintable() and " " not in word):
            table = byte_symbols()
            word = "".join(table[b] for b in word.encode("utf-8", "replace"))
        return word[:-1] + chr(ord(word[-1]) + self.END) if self.suffix else word

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each non-empty word."""
        marked = [self.symbols_of(w) for w in words]
        text = "\x00" + "\x00".join(marked)
        last, length = [-1] * len(text), [0] * len(text)
        start = 0
        for s in marked:
            last[start] = -2
            start += len(s) + 1
        if self.pairs > KEEP_PAIRS:
            self._fresh_pairs()
        for end, (token, n, fits) in self.automaton.iter(text):
            if last[end] == -1:
                before = last[end - n]
                fit = fits.get(before)
                if fit is None:
                    fit = fits[before] = self._apart(before, token, float("inf"))
                    self.pairs += 1
                if fit:
                    last[end], length[end] = token, n
        out, start = [], 0
        for s in marked:
            at, ids = start + len(s), []
            while at > start:
                if last[at] < 0:
                    raise ValueError("a prefix has no last token")
                ids.append(last[at])
                at -= length[at]
            out.append(ids[::-1])
            start += len(s) + 1
        return out


class TextCodec:
    """Texts to ids and back, as the vocabulary file describes."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        self.path, self.library = path, None
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if (model["type"] != "BPE" or spec["decoder"] is not None or model["continuing_subword_prefix"]
                or kinds != ["NFC", "Replace", "Lowercase"] or pre[0].get("type") != "Split" or spec["post_processor"]):
            raise ValueError(f"unsupported vocabulary file {path}")
        self.bpe = Bpe(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.pattern = regex.compile(pre[0]["pattern"]["Regex"].replace(r"\s", WHITE))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = dict(self.bpe.strings) | {i: s for s, i in self.special.items()}
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self._fresh()

    def _fresh(self) -> None:
        # a special token stands under its name behind a space, which no word holds
        self.ids = {" " + s: struct.pack("<I", i) for s, i in self.special.items()}
        self.decoded = {" " + s: s for s in self.special}
        self.chars = 0

    def words(self, text: str) -> list[str]:
        if "<" in text and self.special and self.split.search(text):
            out = []
            for k, part in enumerate(self.split.split(text)):
                out += [" " + part] if k % 2 else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            if recent().search("".join(set(text))):
                return self._by_library(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case goes letter by letter
        text = text.lower()
        if any(c in text for c in SPLIT_ONLY):
            return self.pattern.findall(text)
        out, cut = [], self.pattern.findall
        for piece in text.split():
            if piece.isalpha():
                out.append(piece)
            else:
                front = piece.rstrip(string.punctuation)
                if front.isalpha():
                    out += (front, piece[len(front):])
                else:
                    out += cut(piece)
        return out

    def _by_library(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def learn(self, texts: list[list[str]]) -> None:
        """Encodes the words not seen so far."""
        if len(self.ids) > KEEP_WORDS or self.chars > KEEP_CHARS:
            self._fresh()
        new = list(set().union(*texts).difference(self.ids))
        self.chars += sum(map(len, new))
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            for w, ids in zip(part, self.bpe.encode_words(part)):
                self.ids[w] = struct.pack(f"<{len(ids)}I", *ids)
                self.decoded[w] = " ".join([self.names[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        self.learn([words])
        return np.frombuffer(b"".join([self.ids[w] for w in words]), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.names[i] for i in ids])


@functools.cache
def codec(name: str) -> TextCodec:
    return TextCodec(vocabulary_path(name))


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded text."""
    narrow = docs.select("doc_id", F.col(text).alias("t"))
    schema = (narrow.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string"))
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch, texts in text_batches(batches, 1, max_bytes=2 << 20):
            split = [c.words(t.decode("utf-8", "replace")) if t else [] for t in texts]
            c.learn(split)
            ids = [b"".join(map(c.ids.__getitem__, words)) for words in split]
            back = [" ".join(map(c.decoded.__getitem__, words)) for words in split]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                       pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                       pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back])]
            if with_ids:
                columns += [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array(back)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(run, schema)


@register("op7_bpe_codec")
def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
