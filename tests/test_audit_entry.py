import pytest

from tollgate.operators import audit

# fixed values: the reference's 41 feature names (as listed in its committed outputs)
REFERENCE_FEATURES = """max_gap_between_updates biometric_time_to_update name_missing name_time_to_update_log
address_missing biometric_time_to_update_log mobile_window_completed address_time_to_update mobile_missing
avg_gap_between_updates gap_mobile_to_address name_window_completed name_time_to_update biometric_missing
address_time_to_update_log gap_address_to_name mobile_time_to_update gap_biometric_to_mobile
state_completion_rate name_is_late state_encoded mobile_time_to_update_log urban_rural_completion_rate
urban_rural_encoded pincode address_is_late mobile_is_late gender_encoded eighteenth_birthday_year
eighteenth_birthday_quarter eighteenth_birthday_month eighteenth_birthday_dow district_encoded
district_completion_rate demographic_updates_count current_age biometric_window_completed
biometric_updates_count biometric_is_late address_window_completed years_between_enrolment_and_18""".split()


def test_legacy_audit_reproduces_committed_counts(spark):
    names = spark.createDataFrame([(n,) for n in REFERENCE_FEATURES], "feature string")
    r = audit.legacy_availability(names).collect()
    assert len(r) == 41
    by_day = {d: sum(1 for x in r if x["day"] == d) for d in (0, 30, 60, 90)}
    assert by_day == {0: 21, 30: 5, 60: 5, 90: 7}
    assert sum(1 for x in r if x["day"] is None) == 3          # the *_completion_rate defect
    assert sum(1 for x in r if x["future_knowledge"]) == 21
    assert sum(1 for x in r if x["available"]) == 13
    cats = {c: sum(1 for x in r if x["category"] == c) for c in ("demographic", "geographic", "temporal")}
    assert cats == {"demographic": 4, "geographic": 0, "temporal": 9}


# fixed values: the committed availability report of the reference
COMMITTED_DAYS = {
    0: """address_window_completed biometric_is_late biometric_missing biometric_time_to_update
    biometric_time_to_update_log biometric_updates_count biometric_window_completed current_age
    demographic_updates_count district_encoded eighteenth_birthday_dow eighteenth_birthday_month
    eighteenth_birthday_quarter eighteenth_birthday_year gender_encoded mobile_window_completed
    name_window_completed pincode state_encoded urban_rural_encoded years_between_enrolment_and_18""",
    30: "gap_biometric_to_mobile mobile_is_late mobile_missing mobile_time_to_update mobile_time_to_update_log",
    60: "address_is_late address_missing address_time_to_update address_time_to_update_log gap_mobile_to_address",
    90: """avg_gap_between_updates gap_address_to_name max_gap_between_updates name_is_late name_missing
    name_time_to_update name_time_to_update_log"""}
COMMITTED_FUTURE = """address_is_late address_missing address_time_to_update address_time_to_update_log
avg_gap_between_updates biometric_is_late biometric_missing biometric_time_to_update biometric_time_to_update_log
gap_address_to_name gap_biometric_to_mobile gap_mobile_to_address max_gap_between_updates mobile_is_late
mobile_missing mobile_time_to_update mobile_time_to_update_log name_is_late name_missing name_time_to_update
name_time_to_update_log"""
COMMITTED_AVAILABLE = """address_window_completed biometric_window_completed district_encoded eighteenth_birthday_dow
eighteenth_birthday_month eighteenth_birthday_quarter eighteenth_birthday_year gender_encoded mobile_window_completed
name_window_completed state_encoded urban_rural_encoded years_between_enrolment_and_18"""
COMMITTED_DEMOGRAPHIC = "district_encoded gender_encoded state_encoded urban_rural_encoded"
COMMITTED_TEMPORAL = """address_window_completed biometric_window_completed eighteenth_birthday_dow eighteenth_birthday_month
eighteenth_birthday_quarter eighteenth_birthday_year mobile_window_completed name_window_completed
years_between_enrolment_and_18"""


def test_legacy_audit_reproduces_committed_lists(spark):
    r = audit.legacy_availability(spark.createDataFrame([(n,) for n in REFERENCE_FEATURES], "feature string")).collect()

    def listed(cond):
        return sorted(x["feature"] for x in r if cond(x))
    for day, names in COMMITTED_DAYS.items():
        assert listed(lambda x: x["day"] == day) == names.split()
    assert listed(lambda x: x["future_knowledge"]) == COMMITTED_FUTURE.split()
    assert listed(lambda x: x["available"]) == COMMITTED_AVAILABLE.split()
    assert listed(lambda x: x["category"] == "demographic") == COMMITTED_DEMOGRAPHIC.split()
    assert listed(lambda x: x["category"] == "temporal") == COMMITTED_TEMPORAL.split()
    assert listed(lambda x: x["category"] == "geographic") == []


def test_fixed_classification_places_every_name():
    from tollgate.sources.bindings import CUSTOMER_SPEC
    names = ["urgent_time_to_update", "low_is_late", "gap_high_to_medium", "max_gap_between_updates",
             "state_target_rate", "gender_encoded", "anchor_dow", "high_window_completed"]
    got = {n: audit.classify_name(n, CUSTOMER_SPEC)[0] for n in names}
    assert got == {"urgent_time_to_update": 365, "low_is_late": 2190, "gap_high_to_medium": 1460,
                   "max_gap_between_updates": 2190, "state_target_rate": 0, "gender_encoded": 0,
                   "anchor_dow": 0, "high_window_completed": 730}


def test_entry_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 60
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and set(df.columns) >= {"step", "completion_rate_pct"}


@pytest.mark.parametrize("name", ["cascade_completion_rates", "high_risk_cohorts", "roc_auc"])
def test_queries_match_duckdb_oracle(spark, name):
    import duckdb

    import __spark_entry__ as E
    from conftest import SF_SMALL
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    duck = sorted(tuple(r[cols.index(c)] for c in df.columns) for r in cur.fetchall())
    mine = sorted(tuple(r) for r in df.collect())
    assert len(mine) == len(duck)
    for a, b in zip(mine, duck):
        for x, y in zip(a, b):
            assert x == pytest.approx(y, abs=1e-6) if isinstance(x, float) else x == y
