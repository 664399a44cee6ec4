"""Steps whose cost must not grow faster than the input: schemas, micro-batches, groups, Arrow batches, shuffles."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from featurewright.operators import boosting as B
from featurewright.operators.asof import Lookup, asof_answers, training_set
from featurewright.operators.prep import PrepConfig, SparsePreprocessor
from featurewright.operators.sparse_models import feature_index
from featurewright.plans import q_streaming
from featurewright.session import scratch_path
from featurewright.streaming.features import fresh_paths, run_feature_stream, stream_pickup_features, stream_source, upsert_into_path
from featurewright.streaming.keyed import StreamLookup, lookup_stream

DAY = dt.datetime(2024, 1, 1)


def _at(hours):
    return DAY + dt.timedelta(hours=hours)


def test_sparse_vectors_name_no_level_in_the_schema(spark):
    df = spark.createDataFrame([(i, float(i % 5), f"L{i % 40:02d}", "b" if i % 2 else "a") for i in range(200)], "id int, num double, city string, side string")
    cfg = PrepConfig(["num"], ["city", "side"], None, keep_cols=("id",))
    vectors = feature_index(SparsePreprocessor(cfg).fit(df)).vectors(df)
    assert not vectors.schema["features"].metadata
    got = {r["id"]: r["features"] for r in vectors.collect()}
    assert len(got) == 200
    for i, v in got.items():  # numeric, 39 cities, 1 side; the first level of each is all zeros
        want = {0: (i % 5) / 4, i % 40: 1.0 if i % 40 else (i % 5) / 4, 40: float(i % 2)}
        assert v.size == 41 and dict(zip(map(int, v.indices), v.values)) == {k: x for k, x in want.items() if x}


def test_micro_batches_do_not_grow_with_the_files(spark, monkeypatch):
    sf = scratch_path(spark, "sf")
    rows = [(i, "view", _at(i * 0.7), "{}", float(i), i % 3) for i in range(240)]
    spark.createDataFrame(rows, "event_id bigint, event_type string, ts timestamp_ntz, props string, value double, user_id bigint").repartition(3).write.parquet(f"{sf}/events.parquet")
    out = fresh_paths(spark, "growth")
    monkeypatch.setattr(q_streaming, "fresh_paths", lambda *_: out)
    assert q_streaming.r2_stream_linear_score(spark, sf).count() == 240
    assert spark.read.parquet(out[0]).select("epoch").distinct().count() == 4


def test_upsert_keeps_rows_outside_the_batch_s_keys(spark):
    path = scratch_path(spark, "near")
    run = upsert_into_path(path, ["k", "ts"], "p")
    schema = "k int, ts timestamp_ntz, p string, v int"
    run(spark.createDataFrame([(1, _at(0), "a", 1), (2, _at(5), "a", 1), (None, _at(5), "a", 1), (9, _at(5), "a", 1), (2, _at(9), "b", 1)], schema), 0)
    run(spark.createDataFrame([(2, _at(5), "a", 2), (3, _at(6), "a", 2)], schema), 1)
    got = sorted((r["k"] or 0, r["ts"], r["p"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(0, _at(5), "a", 1), (1, _at(0), "a", 1), (2, _at(5), "a", 2), (2, _at(9), "b", 1), (3, _at(6), "a", 2), (9, _at(5), "a", 1)]


def test_keys_share_groups_of_the_state(spark):
    fdir, edir = scratch_path(spark, "f"), scratch_path(spark, "e")
    out, ckpt = fresh_paths(spark, "groups")
    big, sizes = 2 ** 53 + 1, []
    for b in (0, 1):
        spark.createDataFrame([(k, _at(b), float(10 * k + b)) for k in range(40)], "k bigint, ts timestamp_ntz, v double").coalesce(1).write.mode("append").parquet(fdir)
        spark.createDataFrame([(big + 100 * b + k, k, _at(b + 0.5), None if k % 2 else big + k, None if k % 3 else float("nan"), k % 2 == 0 if k else None) for k in range(41)],
                              "id bigint, k bigint, ts timestamp_ntz, n bigint, x double, even boolean").coalesce(1).write.mode("append").parquet(edir)
        f, e = (stream_source(spark, d, spark.read.parquet(d).schema) for d in (fdir, edir))
        found = lookup_stream(e, "k", [StreamLookup(f, ["v"], "k", "ts", "ts", {"v": "got"})], "1 hour", buckets=2)
        q = found.writeStream.outputMode("append").option("checkpointLocation", ckpt).trigger(availableNow=True).foreachBatch(
            lambda df, n: df.write.mode("append").parquet(out)).start()
        q.awaitTermination()
        sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sizes == [2, 2]
    rows = spark.read.parquet(out).select("*", F.isnan("x").alias("nan")).collect()
    assert len(rows) == 82
    for r in rows:
        b, k = int(r["id"] >= big + 100), r["k"]
        assert r["id"] == big + 100 * b + k and r["ts"] == _at(b + 0.5) and r["n"] == (None if k % 2 else big + k)
        assert r["got"] == (float(10 * k + b) if k < 40 else None) and r["even"] == (k % 2 == 0 if k else None)
        assert (r["nan"] and k % 3 == 0) or (r["x"] is None and k % 3)


def test_boosting_jobs_hold_few_blocks(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["id"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with B._few_blocks(spark):
        got = [r["id"] for r in spark.range(0, 50, 1, 1).mapInArrow(sizes, "id bigint").collect()]
    assert sum(got) == 50 and max(got) <= B.BATCH_BLOCKS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_feature_rows_are_dealt_once(spark):
    feats = spark.createDataFrame([(1, _at(1), 1.0), (1, _at(1), 3.0), (1, _at(1), 2.0), (1, _at(30), 9.0), (2, _at(2), 5.0)], "k int, ts timestamp_ntz, v double")
    base = spark.createDataFrame([(i, k, _at(h)) for i, (k, h) in enumerate([(1, 0.5), (1, 1), (1, 1), (1, 29), (1, 30), (2, 80), (3, 2), (None, 2)])], "id int, k int, ts timestamp_ntz")
    lookups = [Lookup(feats, ["v"], ["k"], "ts")]
    for bucket in ("1 day", ("30 days", "1 day", "1 minute")):
        got = {r["id"]: r["v"] for r in training_set(base, lookups, bucket=bucket).collect()}
        assert got == {0: None, 1: 3.0, 2: 3.0, 3: 3.0, 4: 9.0, 5: 5.0, 6: None, 7: None}
    plan = asof_answers(base, lookups)._jdf.queryExecution().executedPlan().toString()
    assert "max(__f" not in plan


def test_open_windows_share_rows_of_the_state(spark):
    src = scratch_path(spark, "pickups")
    out, ckpt = fresh_paths(spark, "windows")
    schema = "zip int, ts timestamp_ntz, fare double"
    first = [(k, None if h is None else _at(h), f) for k, h, f in [(1, 0.1, 2.0), (1, 0.1, 4.0), (1, 23.9, None), (1, 24.0, 3.0), (None, 23.95, 1.0), (2, 47.9, float("nan")), (2, None, 1.0), (3, 47.9, 1.0)]]
    later = [(1, _at(47.95), 5.0), (2, _at(48.0), 1.0), (3, _at(48.2), 3.0), (4, _at(0.1), 9.0), (None, _at(47.9), None)]  # key 4 is behind the watermark
    sizes = []
    for rows in (first, later):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        feats = stream_pickup_features(stream_source(spark, src, spark.read.parquet(src).schema), "ts", "zip", "fare", "2 hours", groups=2)
        q = run_feature_stream(feats, out, ["zip", "ts"], ckpt)
        q.awaitTermination()
        sizes.append(max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]))
    assert max(sizes) <= 2  # not a row per window
    seen = spark.createDataFrame([r for r in first + later if r[0] != 4], schema).where("ts IS NOT NULL")
    want = seen.groupBy("zip", F.window(F.col("ts").cast("timestamp"), "1 hour", "15 minutes")).agg(F.mean("fare").cast("float").alias("m"), F.count("*").cast("int").alias("n"))
    show = lambda rows: sorted(str((r[0], r[1], r[2], r[3])) for r in rows)
    got = spark.read.parquet(out)
    assert got.schema["zip"].dataType.simpleString() == "int"
    assert show(got.select("zip", "ts", "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip").collect()) == show(
        want.select("zip", F.col("window.end").cast("timestamp_ntz"), "m", "n").collect())
