"""License scans against exact containment in every window."""

import random
import re

import pytest
from llm_helpers import documents, put
from tollgate.llm import op8_license as L


def brute(rows, templates=L.TEMPLATES, least=0.8):
    out = {}
    for d, text in rows:
        w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
        sh = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        for name, t in templates:
            tw = L.template_words(t)
            ts = {tuple(tw[i:i + 5]) for i in range(len(tw) - 4)}
            m = len(tw) - 4
            length = 1 << (m - 1).bit_length()
            for k in range(0, len(sh), length):
                c = len(ts & set(sh[k:k + 2 * length]))
                if c >= least * len(ts):
                    best, wins, first = out.get((d, name), (0, set(), k))
                    out[d, name] = max(best, c / len(ts)), wins | {k}, min(first, k)
    return sorted(((d, n, b, len(w), f) for (d, n), (b, w, f) in out.items()), key=repr)


def rows_():
    rng = random.Random(6)
    noise = lambda n: " ".join(rng.choice(["the", "license", "under", "software", "free", "a", "works", "ü"]) for _ in range(n))
    rows = []
    for i, (_, t) in enumerate(L.TEMPLATES):
        words = t.split()
        rows += [(10 * i, t), (10 * i + 1, noise(37 + i) + " " + t.upper() + "\n" + noise(90)), (10 * i + 2, t + " " + noise(9) + " " + t)]
        if len(words) > 12:
            words[len(words) // 2] = "changed"
            rows.append((10 * i + 3, noise(20) + " " + " ".join(words)))
        rows.append((10 * i + 4, " ".join(words[: len(words) // 2]) + " " + noise(30)))
    return rows + [(900, None), (901, ""), (902, "a b"), (None, "Released under the MIT License."), (903, noise(40000)),
                   (904, "Released### under the$$$ MIT\tLicense" * 1), (905, L.TEMPLATES[0][1]), (905, L.TEMPLATES[0][1])]


def test_query(spark, tmp_path):
    got = L.op8_license_scan(spark, put(documents(spark, rows_()), tmp_path, "documents")).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows_())


def test_no_python_in_the_plan(spark):
    plan = L.op8_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_band_bound():
    for _, t in L.TEMPLATES:
        m = len(L.template_words(t)) - 4
        length = 1 << (m - 1).bit_length()
        assert length / 2 < m <= length
    assert 1 - (1 - 0.8 / 4.2) ** L.BANDS > 0.999998


def test_short_templates_and_empty_table(spark):
    with pytest.raises(ValueError):
        L.license_matches(spark, documents(spark, []), (("x", "too few words"),))
    assert L.license_matches(spark, documents(spark, [])).count() == 0
