"""Longest-processing-time sharding against a plain heap over all groups."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

from llm_helpers import documents, put
from tollgate.llm import op10_sharding as S


def brute(rows, shards=16):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    size = {t: len(ids) * (len(t.encode()) + 1) for t, ids in groups.items()}
    heap, where = [(0, s) for s in range(shards)], {}
    for t in sorted(groups, key=lambda t: (-size[t], hashlib.md5(t.encode()).hexdigest())):
        load, s = heap[0]
        heapq.heapreplace(heap, (load + size[t], s))
        where[t] = s
    return where


def test_query_matches_heap(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("ab", k=rng.choice([1, 3, 3, 8, 8, 8, 60])))) for i in range(900)]
    rows += [(1000 + i, "hot text " * 20) for i in range(400)] + [(2000, None), (2001, ""), (None, "x"), (None, "x"), (7, "again"), (7, "again"), (3000, "é" * 30000)]
    got = S.op10_lpt_sharding(spark, put(documents(spark, rows), tmp_path, "documents")).collect()
    where, slots = brute(rows), defaultdict(list)
    text = defaultdict(set)
    for d, t in rows:
        text[d].add(t or "")
    assert len(got) == len(rows)
    for r in got:
        ts = [t for t in text[r.doc_id] if zlib.crc32(t.encode()) == r.text_crc32]
        assert ts and r.size == len(ts[0].encode()) + 1 and r.shard == where[ts[0]]
        assert r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_runs_equal_single_steps():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.choice([1, 2, 3, 16])
        runs = sorted({rng.randrange(1, 200): rng.choice([1, 2, 5, 40, 100, 333]) for _ in range(6)}.items(), reverse=True)
        a = [(rng.choice([0, 0, 5000]), i) for i in range(n)]
        heapq.heapify(a)
        b = list(a)
        for size, count in runs:
            want = []
            for _ in range(count):
                load, s = b[0]
                heapq.heapreplace(b, (load + size, s))
                want.append(s)
            got = [None] * count
            for first, ranks, cycle in S.place_run(a, size, count):
                for r in range(first, first + ranks):
                    got[r] = cycle[(r - first) % len(cycle)]
            assert got == want and sorted(a) == sorted(b)


def test_few_groups_and_empty_table(spark):
    got = S.shard_rows(spark, documents(spark, [(1, "a"), (2, "a"), (3, "bb")]), 16).collect()
    assert {(r.doc_id, r.shard) for r in got} == {(1, 0), (2, 0), (3, 1)}
    assert S.shard_rows(spark, documents(spark, [])).count() == 0
