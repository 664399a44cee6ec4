"""Hypothesis property tests (few examples: each one runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from featurewright.operators.history import scd2_merge, upsert

ROWS = st.lists(st.tuples(st.integers(0, 8), st.integers(0, 3)), min_size=1, max_size=12)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(target=ROWS, updates=ROWS)
def test_upsert_idempotent_and_keyed(spark, target, updates):
    t = spark.createDataFrame(list({k: v for k, v in target}.items()), "k int, v int")
    u = spark.createDataFrame(list({k: v for k, v in updates}.items()), "k int, v int")
    once = upsert(t, u, ["k"])
    twice = upsert(once, u, ["k"])
    a = sorted(once.collect())
    assert a == sorted(twice.collect())
    want = {**dict(target), **dict(updates)}
    assert {r["k"]: r["v"] for r in a} == want


@SETTINGS
@given(batches=st.lists(ROWS, min_size=1, max_size=3))
def test_scd2_changed_only_keeps_one_active_row(spark, batches):
    stored = spark.createDataFrame(
        [], "id bigint, key int, value int, active_flag string, start_date date, end_date date")
    for i, batch in enumerate(batches):
        inc = spark.createDataFrame(list({k: v for k, v in batch}.items()), "key int, value int")
        stored = scd2_merge(stored, inc, "key", str(dt.date(2020, 1, 1) + dt.timedelta(days=i)),
                            changed_only=True, compare=["value"])
        stored = spark.createDataFrame(stored.collect(), stored.schema)  # next round reads a snapshot
    rows = stored.collect()
    active = {}
    for r in rows:
        if r["active_flag"] == "Y":
            active[r["key"]] = active.get(r["key"], 0) + 1
    keys = {k for b in batches for k, _ in b}
    assert active == {k: 1 for k in keys}
    assert sorted(r["id"] for r in rows) == list(range(len(rows)))
    last = {}
    for b in batches:
        last.update(dict(b))
    assert {r["key"]: r["value"] for r in rows if r["active_flag"] == "Y"} == last
