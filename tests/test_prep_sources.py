import json
import os
import tempfile

import pytest
from tollgate.operators import prep
from tollgate.sources import files


def test_null_safe_join_and_dedupe(spark):
    base = spark.createDataFrame([("a", 1), (None, 2)], "k string, n long")
    other = spark.createDataFrame([("a", 5), ("a", 6), (None, 7)], "k string, m long")
    d = {r["k"]: r["m2"] for r in prep.left_join_counts(base, other, ["k"], "m", "m2").collect()}
    assert d == {"a": 11, None: 7}
    fan = prep.left_join_counts(base, other, ["k"], "m", "m2", dedupe=False)
    assert fan.count() == 3
    strict = prep.left_join_counts(base, other, ["k"], "m", "m2", null_safe=False)
    assert {r["k"]: r["m2"] for r in strict.collect()}[None] is None


def test_expand_counts_chunks(spark):
    df = spark.createDataFrame([("x", 7), ("y", 0), ("z", None), ("w", -1), ("v", 1)], "k string, n long")
    out = prep.expand_counts(df, "n", ["k"], chunk=3, spread=4)
    rows = sorted((r["k"], r["idx"]) for r in out.collect())
    assert rows == [("v", 0)] + [("x", i) for i in range(7)]
    assert out.where("k = 'x'").select("entity_id").distinct().count() == 7


def test_union_by_name_and_defaults(spark):
    a = spark.createDataFrame([(1, "p")], "id long, s string")
    b = spark.createDataFrame([(2, 3.0)], "id long, x double")
    u = prep.union_by_name([a, b])
    assert sorted(u.columns) == ["id", "s", "x"] and u.count() == 2
    assert prep.with_default(a, "urban_rural", "Unknown", "string").first()["urban_rural"] == "Unknown"
    v = prep.validate_required(spark.createDataFrame([(None, "x"), ("m", None), ("m", "x")], "g string, s string"),
                               ["g", "s"])
    assert [r["error"] for r in v.collect()] == ["Missing required field: g", "Missing required field: s", None]


def test_clean_counts(spark):
    df = spark.createDataFrame([("5-1-2020", "  jammu-kashmir ", "x", 500001, 3)],
                               "date string, state string, district string, pincode long, n long")
    r = prep.clean_counts(df).first()
    assert r["state"] == "Jammu-Kashmir" and r["urban_rural"] == "Urban" and r["date"].day == 5


def test_csv_folder_reader(spark):
    d = tempfile.mkdtemp(prefix="tollgate-csv-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("date,state,district,pincode,age_18_greater\n01-02-2020,x,y,500001,3\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("date,state,district,pincode,age_18_greater\n02-02-2020,x,y,notanumber,4\n")
    df = files.load_enrolment(spark, d)
    rows = df.collect()
    assert len(rows) == 2 and sum(1 for r in rows if r["_corrupt"] is not None) == 1
    assert files.load_enrolment(spark, d, ["a.csv", "missing.csv"]).count() == 1
    with pytest.raises(FileNotFoundError):
        files.load_enrolment(spark, d, ["missing.csv"])


def _write(folder, **contents):
    for name, text in contents.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(text)


def test_csv_columns_bind_by_name(spark):
    """Reordered, extra, absent and repeated columns, a BOM, a short, a long and a corrupt line."""
    d = tempfile.mkdtemp(prefix="tollgate-csv-")
    _write(d, extra="date,state,district,pincode,age_0_5,age_5_17,age_18_greater\n01-02-2020,x,y,500001,11,22,33\n",
           order="\ufeffstate, date ,age_18_greater,district,pincode\ns2,02-02-2020,44,d2,500002\n",
           absent="date,state,age_18_greater\n03-02-2020,s3,55\n",
           twice="date,state,state,district,pincode,age_18_greater\n04-02-2020,s4,no,d4,500004,66\n",
           bad="date,state,district,pincode,age_18_greater\n05-02-2020,s5,d5\n06-02-2020,s6,d6,500006,7,extra\n"
               "07-02-2020,s7,d7,500007,many\n")
    rows = {r["date"][:2]: r for r in files.load_enrolment(spark, d).collect()}
    got = {k: (r["state"], r["district"], r["pincode"], r["age_18_greater"]) for k, r in rows.items()}
    assert got["01"] == ("x", "y", 500001, 33) and got["02"] == ("s2", "d2", 500002, 44)
    assert got["03"] == ("s3", None, None, 55) and got["04"] == ("s4", "d4", 500004, 66)
    assert {k for k, r in rows.items() if r["_corrupt"]} == {"05", "06", "07"} and got["07"] == ("s7", "d7", 500007, None)
    ok, bad = files.split_corrupt(files.load_enrolment(spark, d))
    assert ok.count() == 4 and bad.count() == 3 and "_corrupt" not in ok.columns


def test_score_request_columns_bind_by_name(spark):
    d = tempfile.mkdtemp(prefix="tollgate-csv-")
    _write(d, a="pincode,gender,note,aadhaar_id,state,urban_rural,eighteenth_birthday\n500001,F,hi,7,s,Urban,2020-01-05\n")
    for path in (d, os.path.join(d, "a.csv")):
        r = files.score_requests_csv(spark, path).first()
        assert (r["aadhaar_id"], r["gender"], r["pincode"], r["district"], r["enrolment_date"]) == ("7", "F", 500001, None, None)
        assert r["eighteenth_birthday"].isoformat() == "2020-01-05"
    with pytest.raises(FileNotFoundError):
        files.score_requests_csv(spark, os.path.join(d, "none.csv"))


def test_json_requests_single_and_array(spark):
    d = tempfile.mkdtemp(prefix="tollgate-json-")
    rec = {"aadhaar_id": "1", "gender": "M", "state": "s", "district": "d", "urban_rural": "Urban",
           "eighteenth_birthday": "2020-01-01"}
    with open(os.path.join(d, "one.json"), "w") as f:
        json.dump(rec, f)
    with open(os.path.join(d, "many.json"), "w") as f:
        json.dump({"citizens": [rec, dict(rec, aadhaar_id="2")]}, f)
    df = files.score_requests_json(spark, d)
    assert sorted(r["aadhaar_id"] for r in df.collect()) == ["1", "1", "2"]


def test_expanded_ids_are_injective(spark):
    df = spark.createDataFrame([("a_b", "c", 1), ("a", "b_c", 1), (None, "x", 1), ("", "x", 1)],
                               "k1 string, k2 string, n long")
    ids = [r["entity_id"] for r in prep.expand_counts(df, "n", ["k1", "k2"]).collect()]
    assert len(set(ids)) == 4
