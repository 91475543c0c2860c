"""Line dedup against a brute-force version."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import documents, put
from tollgate.llm import op9_lines as L


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))


def brute(rows, min_docs=10, min_chars=1):
    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(key(x)) < min_chars or seen[key(x)] < min_docs]
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def rows_():
    rows = [(i, f"Common Line\nown {i}\n\n{'  common line' if i % 2 else 'É'}\nnine {i // 9}\nten {i // 10}\t") for i in range(45)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "COMMON LINE"), (103, "COMMON LINE"), (None, "x\ncommon line\r\ny"),
             (104, "common line\n" * 3000), (105, "common\x85line\nK"), (106, "a very long line " * 5000)]
    return rows


def digest(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_query(spark, tmp_path):
    got = L.op9_line_dedup(spark, put(documents(spark, rows_()), tmp_path, "documents")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, n, k, digest(t)) for d, n, k, t in brute(rows_())), key=repr)


@pytest.mark.parametrize("min_docs,min_chars", [(1, 1), (2, 4), (10, 3)])
def test_other_parameters(spark, min_docs, min_chars):
    got = L.dropped_lines(spark, documents(spark, rows_()), min_docs, min_chars).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, n, k, digest(t)) for d, n, k, t in brute(rows_(), min_docs, min_chars)), key=repr)


def test_drop_lines_keeps_columns(spark):
    docs = documents(spark, rows_())
    got = L.drop_lines(spark, docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    want = sorted((d, t if src is not None else None, len(t) if src is not None else None)
                  for (d, _, _, t), (_, src) in zip(brute(rows_()), rows_()) if d is not None)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect() if r.doc_id is not None) == want


def test_index_is_minimal_and_exact(monkeypatch):
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**63, (5000, 2), dtype=np.uint64), axis=0)
    index = L.LineIndex.from_bytes(L.LineIndex.build(keys, np.arange(len(keys)) + 1).to_bytes())
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert (index.count(keys) == np.arange(len(keys)) + 1).all()
    assert (index.count(keys ^ np.uint64(1)) == 0).all()


def test_many_shards_and_a_small_cache(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(L, "SHARD_KEYS", 2)
    got = L.dropped_lines(spark, documents(spark, rows_()), 2).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, n, k, digest(t)) for d, n, k, t in brute(rows_(), 2)), key=repr)


def test_empty_table(spark):
    assert L.dropped_lines(spark, documents(spark, [])).count() == 0
    assert L.drop_lines(spark, documents(spark, [])).count() == 0
