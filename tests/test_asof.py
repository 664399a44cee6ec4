"""As-of lookup: known answers, bucket carry-over, embargo, and a hot key against brute force."""

import datetime as dt
import random

import pandas as pd

from featurewright.operators.asof import NESTED_BUCKETS, Lookup, asof_lookup

T0 = dt.datetime(2024, 1, 1)


def _feats(spark, rows):
    return spark.createDataFrame(rows, "zip bigint, ts timestamp_ntz, f double")


def _base(spark, rows):
    return spark.createDataFrame(rows, "id bigint, zip bigint, t timestamp_ntz")


def test_known_answers(spark):
    feats = _feats(spark, [(1, T0 + dt.timedelta(hours=1), 10.0), (1, T0 + dt.timedelta(hours=3), 30.0)])
    base = _base(spark, [
        (1, 1, T0 + dt.timedelta(hours=1)),    # same instant -> matches
        (2, 1, T0 + dt.timedelta(hours=2)),    # later feature does not match
        (3, 1, T0),                            # nothing earlier -> null
        (4, 2, T0 + dt.timedelta(hours=5)),    # other key -> null
        (5, 1, T0 + dt.timedelta(days=3)),     # carried over from an earlier bucket
    ])
    lk = Lookup(feats, ["f"], ["zip"], "t", table_ts="ts")
    got = {r["id"]: r["f"] for r in asof_lookup(base, lk, bucket="1 day").collect()}
    assert got == {1: 10.0, 2: 10.0, 3: None, 4: None, 5: 30.0}


def test_embargo(spark):
    feats = _feats(spark, [(1, T0, 1.0), (1, T0 + dt.timedelta(minutes=30), 2.0)])
    base = _base(spark, [(1, 1, T0 + dt.timedelta(minutes=30)), (2, 1, T0 + dt.timedelta(minutes=50))])
    lk = Lookup(feats, ["f"], ["zip"], "t", table_ts="ts")
    got = {r["id"]: r["f"] for r in asof_lookup(base, lk, embargo="15 minutes").collect()}
    assert got == {1: 1.0, 2: 2.0}


def test_hot_key_matches_brute_force(spark):
    rnd = random.Random(3)
    feats = [(1 if rnd.random() < 0.7 else rnd.randint(2, 5), T0 + dt.timedelta(minutes=rnd.randint(0, 6000)),
              float(i)) for i in range(400)]
    fdf = pd.DataFrame(feats, columns=["zip", "ts", "f"]).drop_duplicates(["zip", "ts"])
    base = [(i, 1 if rnd.random() < 0.7 else rnd.randint(2, 6), T0 + dt.timedelta(minutes=rnd.randint(-100, 7000)))
            for i in range(600)]
    frows = [(int(z), t.to_pydatetime(), float(f)) for z, t, f in fdf.itertuples(index=False, name=None)]
    lk = Lookup(_feats(spark, frows), ["f"], ["zip"], "t", table_ts="ts")
    got = {r["id"]: r["f"] for r in asof_lookup(_base(spark, base), lk, bucket="6 hours").collect()}
    for i, z, t in base:
        cand = fdf[(fdf.zip == z) & (fdf.ts <= t)]
        want = None if cand.empty else cand.sort_values("ts").iloc[-1]["f"]
        assert got[i] == want, (i, z, t)


def test_multilevel_buckets_match_single_level(spark):
    rnd = random.Random(11)
    feats = [(rnd.randint(1, 3), T0 + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)), float(i)) for i in range(300)]
    fdf = pd.DataFrame(feats, columns=["zip", "ts", "f"]).drop_duplicates(["zip", "ts"])
    frows = [(int(z), t.to_pydatetime(), float(f)) for z, t, f in fdf.itertuples(index=False, name=None)]
    base = [(i, rnd.randint(1, 4), T0 + dt.timedelta(seconds=rnd.randint(-3600, 6 * 86400))) for i in range(400)]
    lk = Lookup(_feats(spark, frows), ["f"], ["zip"], "t", table_ts="ts")
    one = {r["id"]: r["f"] for r in asof_lookup(_base(spark, base), lk, bucket="1 day").collect()}
    three = {r["id"]: r["f"] for r in
             asof_lookup(_base(spark, base), lk, bucket=("2 days", "1 hour", "1 minute")).collect()}
    assert one == three
    for i, z, t in base[:100]:
        cand = fdf[(fdf.zip == z) & (fdf.ts <= t)]
        want = None if cand.empty else cand.sort_values("ts").iloc[-1]["f"]
        assert three[i] == want


def test_nested_buckets_equal_one_bucket(spark):
    rnd = random.Random(2)
    feats = [(1, T0 + dt.timedelta(seconds=rnd.randint(0, 86400)), float(i)) for i in range(200)]
    base = [(i, 1, T0 + dt.timedelta(seconds=rnd.randint(0, 90000))) for i in range(200)]
    lk = Lookup(_feats(spark, feats), ["f"], ["zip"], "t", table_ts="ts")
    nested = {r["id"]: r["f"] for r in asof_lookup(_base(spark, base), lk, bucket=NESTED_BUCKETS).collect()}
    day = {r["id"]: r["f"] for r in asof_lookup(_base(spark, base), lk, bucket="1 day").collect()}
    assert nested == day


def test_feature_ties_give_the_largest_in_bucket_and_carried(spark):
    feats = [(1, T0, 1.0), (1, T0, 3.0), (1, T0, 2.0)]
    base = [(0, 1, T0), (1, 1, T0 + dt.timedelta(days=5))]
    lk = Lookup(_feats(spark, feats), ["f"], ["zip"], "t", table_ts="ts")
    assert {r["id"]: r["f"] for r in asof_lookup(_base(spark, base), lk).collect()} == {0: 3.0, 1: 3.0}


def test_composite_key_and_rename(spark):
    feats = spark.createDataFrame(
        [(1, "a", T0, 1.0), (1, "b", T0, 2.0), (1, "a", T0 + dt.timedelta(hours=1), 3.0)],
        "zip bigint, kind string, ts timestamp_ntz, f double",
    )
    base = spark.createDataFrame(
        [(1, 1, "a", T0 + dt.timedelta(minutes=30)), (2, 1, "b", T0 + dt.timedelta(hours=2)),
         (3, 1, "a", T0 + dt.timedelta(hours=2)), (4, 1, "c", T0 + dt.timedelta(hours=2))],
        "id bigint, z bigint, k string, t timestamp_ntz",
    )
    lk = Lookup(feats, ["f"], ["z", "k"], "t", table_key=["zip", "kind"], table_ts="ts", rename={"f": "f_latest"})
    out = asof_lookup(base, lk)
    assert "f_latest" in out.columns and "f" not in out.columns
    assert {r["id"]: r["f_latest"] for r in out.collect()} == {1: 1.0, 2: 2.0, 3: 3.0, 4: None}
