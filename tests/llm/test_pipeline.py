"""The corpus pipeline against brute-force versions of its stages."""

import hashlib
import random

import numpy as np
import pytest
from llm_helpers import documents, put
from test_op2_simhash import brute_components, near
from test_op5_quality import brute as quality
from test_op9_lines import brute as lines
from tokenizers import Tokenizer
from tollgate.llm import op3_mixing as M
from tollgate.llm.op7_bpe import vocabulary_path

import corpus_pipeline as P


def rows_():
    rng = random.Random(12)
    text = lambda n, k=300: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    base = [[f"w{rng.randrange(300)}" for _ in range(200)] for _ in range(8)]
    rows = [(i, f"{text(60)}\nShared Line Here\n{text(40)}") for i in range(40)]
    rows += [(100 + i, near(rng, base[i % 8], 1)) for i in range(24)] + [(200 + i, " ".join(base[0])) for i in range(12)]
    rows += [(300, None), (301, ""), (302, "too short"), (303, text(5) * 40), (304, "shared line here\n" + "\n".join(["Shared Line Here"] * 3)),
             (305, " ".join(["###", "$$$"] * 40)), (306, "É ü " + text(30)), (None, text(50)), (307, text(20_000, 9000)), (5, text(30))]
    return rows


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute(rows, copies):
    rows = [(d, t) for d, t in rows if quality(t)[-1]]
    rows = [(d, t) for d, _, _, t in lines(rows)]
    comp, kept = {}, []
    for (d, fp, c), _ in zip(brute_components(rows), rows):
        comp.setdefault(c, []).append(d)
    first = {c for c in comp}
    seen = set()
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if d in first and d not in seen:
            kept.append((d, t))
            seen.add(d)
    lib = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    out = []
    for d, t in kept:
        ids = lib.encode(t, add_special_tokens=False).ids
        out += [(d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())] * copies(d)
    return sorted(out, key=repr)


def test_run_matches_brute_force(spark, tmp_path):
    rows = [r for r in rows_() if r[0] is not None and r != (5, rows_()[-1][1])]  # unique ids: brute force needs them
    folder = put(documents(spark, rows), tmp_path, "documents")
    put(labelled(spark, [(i, 1, 0) for i in range(30)]), tmp_path, "labels")      # one domain: every rate is 1
    got = sorted(map(tuple, P.run(spark, folder).collect()), key=repr)
    assert got == brute(rows, lambda d: 1)


def test_run_mixes_several_domains(spark, tmp_path):
    """run() against brute force with labelled good, poor and toxic texts and rates other than 1."""
    rng = random.Random(5)
    words = {d: [f"{d}{i}" for i in range(400)] for d in ("good", "poor", "toxic")}
    kind = ["good"] * 60 + ["poor"] * 2 + ["toxic"] * 18  # poor is scarce, toxic is plentiful
    rows = [(i, " ".join(rng.choice(words[d] + words["good"][:50]) for _ in range(120))) for i, d in enumerate(kind)]
    folder = put(documents(spark, rows), tmp_path, "documents")
    labels = labelled(spark, [(i, int(d != "poor"), int(d == "toxic")) for i, d in enumerate(kind)])
    put(labels, tmp_path, "labels")
    kept = [(d, t) for d, _, _, t in lines([r for r in rows if quality(r[1])[-1]])]
    rates = {r.doc_id: r for r in M.document_rates(spark, documents(spark, kept), labels).collect()}
    got = sorted(map(tuple, P.run(spark, folder).collect()), key=repr)
    assert got == brute(rows, lambda d: rates[d].copies)
    rate = {d: [rates[i].rate for i, x in enumerate(kind) if x == d] for d in words}
    assert max(rate["toxic"]) < 0.6 and np.mean(rate["good"]) > 0.9 and max(map(max, rate.values())) <= M.MOST
    share = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rates.values()) for d in words}
    whole = sum(share.values())
    assert all(abs(share[d] / whole - M.TARGETS[d]) <= 5e-3 for d in words)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = documents(spark, rows_())
    put(labelled(spark, [(i, i % 2, 0) for i in range(40)]), tmp_path, "labels")
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).checkpoint()
        assert docs.columns == documents(spark, []).columns, name
        assert docs.count() > 0


def test_mixing_decides_the_copies(spark, tmp_path):
    docs = documents(spark, [r for r in rows_() if r[0] is not None and r[1]][:60])
    labels = labelled(spark, [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(40)])
    put(labels, tmp_path, "labels")
    want = {r.doc_id: r.copies for r in M.document_rates(spark, docs, labels).collect()}
    got = P.mix_sources(spark, docs, str(tmp_path)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {d: n for d, n in want.items() if n}


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables_pass_through(spark, tmp_path, rows):
    folder = put(documents(spark, rows), tmp_path, "documents")
    put(labelled(spark, []), tmp_path, "labels")
    assert P.run(spark, folder).count() == 0
