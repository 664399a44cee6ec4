"""Keyed state and late rows of the streaming jobs, batch by batch."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurewright.session import scratch_path
from featurewright.streaming import late
from featurewright.streaming.features import fresh_paths, stream_source
from featurewright.streaming.keyed import StreamLookup, _History, lookup_stream

DAY = dt.datetime(2024, 1, 1)


def _at(hours):
    return None if hours is None else DAY + dt.timedelta(hours=hours)


def test_history_as_of_and_retention():
    h = _History(np.zeros(0, np.int64), np.zeros((0, 1))).with_rows(np.array([30, 10, 20, 10]), np.array([[3.0], [1.0], [2.0], [1.5]]))
    assert h.at.tolist() == [10, 20, 30] and h.values[:, 0].tolist() == [1.5, 2.0, 3.0]
    got = h.as_of(np.array([5, 10, 19, 20, 99]), None)[:, 0]
    assert np.isnan(got[0]) and got[1:].tolist() == [1.5, 1.5, 2.0, 3.0]
    assert np.isnan(h.as_of(np.array([40]), 10)[0, 0]) and h.as_of(np.array([39]), 10)[0, 0] == 3.0
    assert h.kept(5).at.tolist() == [20, 30]  # 20 was valid five before the newest
    assert h.kept(None).at.tolist() == [10, 20, 30]
    for max_age in (1, 3, 7, 11, 25):  # whatever retention leaves answers like the whole history, from the newest on
        for t in range(30, 60):
            whole, kept = h.as_of(np.array([t]), max_age), h.kept(max_age).as_of(np.array([t]), max_age)
            assert np.array_equal(whole, kept, equal_nan=True)


def _run(spark, features, events, batches, max_age=None):
    """Feed the batches one query each, all from one checkpoint; returns the output and the state's size after each."""
    fs, es = "k int, ts timestamp_ntz, v double", "id int, k int, ts timestamp_ntz"
    fdir, edir = scratch_path(spark, "f"), scratch_path(spark, "e")
    out, ckpt = fresh_paths(spark, "keyed")
    sizes = []
    for b in batches:
        spark.createDataFrame([(k, _at(t), v) for bb, k, t, v in features if bb == b], fs).coalesce(1).write.mode("append").parquet(fdir)
        spark.createDataFrame([(i, k, _at(t)) for bb, i, k, t in events if bb == b], es).coalesce(1).write.mode("append").parquet(edir)
        f = stream_source(spark, fdir, spark.read.parquet(fdir).schema)
        e = stream_source(spark, edir, spark.read.parquet(edir).schema)
        found = lookup_stream(e, "k", [StreamLookup(f, ["v"], "k", "ts", "ts", {"v": "got"})], "1 hour", max_age)
        q = found.writeStream.outputMode("append").option("checkpointLocation", ckpt).trigger(availableNow=True).foreachBatch(
            lambda df, n: df.write.mode("overwrite").parquet(f"{out}/epoch={n}")).start()
        q.awaitTermination()
        sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    return {r["id"]: r["got"] for r in spark.read.parquet(out).collect()}, sizes


FEATURES = [(0, 1, 0, 1.0), (0, 1, 5, 2.0), (0, 2, 1, 7.0), (1, 1, 8, 3.0), (2, 1, 100, 4.0), (3, 1, 200, 5.0)]
EVENTS = [(0, 10, 1, 5), (0, 11, 1, 4.9), (0, 12, 2, 0.5), (0, 13, None, 3), (1, 20, 1, 7), (1, 21, 2, 9), (1, 22, 9, 9), (2, 30, 2, 101), (3, 40, 1, 201), (3, 41, 2, 201)]


def test_state_outlives_restarts(spark):
    got, sizes = _run(spark, FEATURES, EVENTS, [0, 1, 2, 3])
    assert got == {10: 2.0, 11: 1.0, 12: None, 13: None, 20: 2.0, 21: 7.0, 22: None, 30: 7.0, 40: 5.0, 41: 7.0}
    assert sizes[-1] == 2  # keys 1 and 2; null and unknown keys leave nothing


def test_old_features_do_not_count_and_leave_the_state(spark):
    got, sizes = _run(spark, FEATURES, EVENTS, [0, 1, 2, 3], max_age="24 hours")
    assert got == {10: 2.0, 11: 1.0, 12: None, 13: None, 20: 2.0, 21: 7.0, 22: None, 30: None, 40: 5.0, 41: None}
    assert sizes[1] == 2 and sizes[-1] == 1  # key 2 was evicted


def _batch(spark, rows):
    return spark.createDataFrame([(i, _at(t), u, v) for i, t, u, v in rows], "event_id int, ts timestamp_ntz, user_id int, value double")


def test_late_rows_are_kept_aside_and_a_retry_changes_nothing(spark):
    root = scratch_path(spark, "late")
    run = late.admit_into(root, "ts", "user_id", "value", "2 hours", "1 hour", "15 minutes")
    first = _batch(spark, [(1, 0.1, 7, 1.0), (2, 9.0, 7, 3.0), (3, None, 7, 5.0)])
    second = _batch(spark, [(4, 6.9, 7, 10.0), (5, 7.0, 7, 20.0), (6, 0.1, 8, None), (7, 9.1, 7, 5.0)])
    run(first, 0)
    run(second, 1)
    run(_batch(spark, []), 2)
    run(_batch(spark, [(8, 7.5, 7, 1.0), (9, 6.0, 7, 1.0)]), 3)

    def state():
        aside = sorted((r["event_id"], r["epoch"], r["watermark"]) for r in late.late_rows(spark, root).collect())
        marks = sorted((r["epoch"], r["rows"], r["late_rows"]) for r in late.marks(spark, root).collect())
        feats = {(r["zip"], r["ts"]): (r["mean_fare_window_1h_pickup_zip"], r["count_trips_window_1h_pickup_zip"]) for r in late.window_features(spark, root).collect()}
        return aside, marks, feats

    aside, marks, feats = before = state()
    assert [(i, e) for i, e, _ in aside] == [(3, 0), (4, 1), (6, 1), (9, 3)]
    assert aside[0][2] is None and aside[1][2] == _at(7) and aside[3][2] == DAY + dt.timedelta(hours=7, minutes=6)
    assert marks == [(0, 3, 1), (1, 4, 2), (2, 0, 0), (3, 2, 1)]
    assert feats[7, _at(10)] == (4.0, 2) and feats[7, _at(8)] == (10.5, 2) and all(z == 7 for z, _ in feats)
    run(_batch(spark, [(8, 7.5, 7, 1.0), (9, 6.0, 7, 1.0)]), 3)
    assert state() == before
    with pytest.raises(FileNotFoundError, match="mark"):
        late.watermark_before(spark, root, 9, "1 hour")


def test_values_may_be_null(spark):
    root = scratch_path(spark, "late-null")
    late.admit_into(root, "ts", "user_id", "value", "1 hour", "1 hour", "15 minutes")(_batch(spark, [(1, 0.1, 7, None), (2, 0.1, 7, 4.0), (3, 0.1, 9, None)]), 0)
    got = {(r[0]): (r[3], r[4]) for r in late.window_features(spark, root).where(F.col("ts") == F.lit(_at(1))).collect()}
    assert got == {7: (4.0, 2), 9: (None, 1)}
