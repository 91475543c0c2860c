"""SimHash near-dedup against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash
from llm_helpers import documents, put
from tollgate.llm import op2_simhash as S


def brute_fp(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, most=4):
    fps = [brute_fp(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                label[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", ids.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def near(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"w{rng.randrange(50)}"
    return " ".join(out)


def rows_():
    rng = random.Random(3)
    base = [[f"w{rng.randrange(400)}" for _ in range(300)] for _ in range(25)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    rows += [(100 + i, near(rng, base[i % 5], 1 + i % 3)) for i in range(60)]  # chains of near copies
    rows += [(200 + i, " ".join(base[7]).upper()) for i in range(30)]          # a large group of copies
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "A"), (304, "a b c d"), (305, "ü É"), (None, "a b c d"),
             (306, " ".join(base[8])), (306, " ".join(base[8])), (307, "w1 " * 20000)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return put(documents(spark, rows_()), tmp_path_factory.mktemp("op2"), "documents")


def test_matches_brute_force(spark, folder):
    got = S.op2_simhash_near_dedup(spark, folder)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_components(rows_())


def test_bucket_links_find_every_pair():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 40, dtype=np.uint64)
    x = [centre]
    for k in range(1, 7):
        y = centre.copy()
        for _ in range(k):
            y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
        x.append(y)
    x = np.unique(np.concatenate(x))
    bits = [0, 5, 9]
    found = [np.zeros((0, 2), int)]
    for b in range(8):
        found += list(S._meet(x, bits, b, 2))
    label = S._forest(len(x), np.concatenate(found))
    d = np.bitwise_count(x[:, None] ^ x[None, :])
    want = S._forest(len(x), np.argwhere((d <= 4) & (d > 0)))
    assert (label == want).all()


def test_points_are_made_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    x = np.unique(np.concatenate([rng.integers(0, 2**20, 60, dtype=np.uint64), rng.integers(0, 2**20, 60, dtype=np.uint64)]))
    def links():
        return S._forest(len(x), np.concatenate([np.zeros((0, 2), int), *S._meet(x, [], 0, 2)]))
    whole = links()
    monkeypatch.setattr(S, "POINTS", 5000)
    assert (links() == whole).all()


def test_one_per_component_keeps_columns_and_rows(spark):
    docs = documents(spark, rows_())
    kept = S.one_per_component(spark, docs)
    assert kept.columns == docs.columns
    comps = {c for _, _, c in brute_components(rows_())}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(comps)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert S.near_duplicates(spark, docs).count() == 0
    assert S.one_per_component(spark, docs).count() == 0


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000)).encode()
    whole = S.simhash(text)
    monkeypatch.setattr(S, "WORDS_AT_ONCE", 100)
    assert S.simhash(text) == whole == brute_fp(text.decode())
