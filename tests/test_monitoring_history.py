"""Violation check, champion replay, SCD2, upsert and row index (FIXTURES.md + properties)."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from featurewright.operators.asof import NESTED_BUCKETS
from featurewright.operators.history import champion_history, scd2_merge, upsert
from featurewright.operators.scan import row_index
from featurewright.plans.monitoring import metric_violated

D = dt.datetime(2024, 1, 1)


def _profile(spark, values):
    # values are latest first
    rows = []
    n = len(values)
    for i, v in enumerate(values):
        start = D + dt.timedelta(days=n - 1 - i)
        rows.append(((start, start + dt.timedelta(days=1)), "m1", ":table", None, "INPUT",
                     None if v is None else float(v)))
    return spark.createDataFrame(
        rows,
        "window struct<start: timestamp, end: timestamp>, model_id string, column_name string, "
        "slice_key string, log_type string, rmse double",
    )


def test_violation_cases(spark):
    cases = {(120, 50, 130, 40, 30): 1, (90, 150, 150, 150, 150): 0, (120, 50, 50, 50, 50): 0,
             (None, 150, 150, 0, 0): 0}
    for vals, want in cases.items():
        got = metric_violated(_profile(spark, list(vals)), "rmse", 100.0, 5, 2).collect()[0]["query_result"]
        assert got == want, vals


def test_champion_replay(spark):
    runs = spark.createDataFrame(
        [(str(i + 1), "m", D + dt.timedelta(days=i), v) for i, v in enumerate([0.5, 0.5, 0.7, 0.6, 0.8])],
        "run_id string, model_name string, created timestamp_ntz, metric double",
    )
    h = {r["run_id"]: r for r in champion_history(runs).collect()}
    assert [k for k in sorted(h) if h[k]["is_champion"] == 1] == ["1", "3", "5"]
    assert [h[k]["challenger_run_id"] for k in ("1", "3", "5")] == ["1", "1", "3"]


def test_scd2_changed_only_one_active_per_key(spark):
    stored = spark.createDataFrame(
        [(0, 1, 1.0, "Y", dt.date(2020, 1, 1), None), (1, 2, 2.0, "Y", dt.date(2020, 1, 1), None),
         (2, 3, 3.0, "N", dt.date(2019, 1, 1), dt.date(2020, 1, 1))],
        "id bigint, key bigint, value double, active_flag string, start_date date, end_date date",
    )
    incoming = spark.createDataFrame([(1, 1.0), (2, 9.0), (4, 4.0)], "key bigint, value double")
    out = scd2_merge(stored, incoming, "key", "2021-01-01", changed_only=True, compare=["value"])
    rows = out.collect()
    active = {}
    for r in rows:
        if r["active_flag"] == "Y":
            active[r["key"]] = active.get(r["key"], 0) + 1
    assert active == {1: 1, 2: 1, 4: 1}
    assert sorted(r["id"] for r in rows) == list(range(len(rows)))
    parity = scd2_merge(stored, incoming, "key", "2021-01-01").collect()
    assert len(parity) == 6  # 3 stored + 3 inserted, keys 1 and 2 closed


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    u = spark.createDataFrame([(2, "B"), (3, "c")], "k bigint, v string")
    once = upsert(t, u, ["k"])
    twice = upsert(once, u, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert dict((r["k"], r["v"]) for r in once.collect()) == {1: "a", 2: "B", 3: "c"}


def test_row_index_equals_row_number(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 10**9), rnd.choice([None, rnd.randint(0, 5)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").dropDuplicates(["a"])
    got = row_index(df, [F.col("b").asc_nulls_last(), "a"], "id", num_partitions=7)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("b").asc_nulls_last(), "a")) - 1)
    j = got.join(want.drop("b"), "a")
    assert j.count() == df.count()
    assert j.where("id != rn").count() == 0


def test_quality_monitor_refresh_incremental(spark):
    import os

    from featurewright.plans.monitoring import QualityMonitor, quality_profile

    rows = [("a" if i % 3 else "b", float(i % 7), float(i % 5), D + dt.timedelta(hours=5 * i)) for i in range(60)]
    log = spark.createDataFrame(rows, "model_id string, prediction double, price double, timestamp timestamp_ntz")
    spark.sql("CREATE DATABASE IF NOT EXISTS fw_test_db")
    name = f"fw_test_db.pred_{os.getpid()}"
    log.write.saveAsTable(name)
    mon = QualityMonitor(spark, name, "model_id", "prediction", "price", "timestamp")
    mon.refresh()
    full = spark.table(mon.output_table)
    want = quality_profile(log, "timestamp", "model_id", "prediction", "price")
    assert full.count() == want.count() and full.exceptAll(want.select(*full.columns)).count() == 0
    for since in ("2024-01-08", "2024-01-09 13:45:00"):  # day-aligned and mid-window
        mon.refresh(since=since)  # recompute the tail only: same table
        again = spark.table(mon.output_table)
        assert again.count() == want.count() and again.exceptAll(want.select(*again.columns)).count() == 0
    got = mon.violated("root_mean_squared_error", 1.0).collect()[0]["query_result"]
    assert got == metric_violated(want, "root_mean_squared_error", 1.0).collect()[0]["query_result"]


def test_champion_replay_bucket_levels_agree(spark):
    rnd = random.Random(4)
    rows = [(str(i), f"m{rnd.randint(0, 2)}", D + dt.timedelta(minutes=rnd.randint(0, 9 * 1440)), rnd.random())
            for i in range(300)]
    runs = spark.createDataFrame(rows, "run_id string, model_name string, created timestamp_ntz, metric double")
    ref = {r["run_id"]: (r["is_champion"], r["challenger_run_id"]) for r in champion_history(runs).collect()}
    for bucket in (("7 days", "1 day", "1 hour"), NESTED_BUCKETS, "1 hour"):
        got = {r["run_id"]: (r["is_champion"], r["challenger_run_id"])
               for r in champion_history(runs, bucket=bucket).collect()}
        assert got == ref, bucket
    # brute force for one model
    for m in ("m0", "m1", "m2"):
        seq = sorted([r for r in rows if r[1] == m], key=lambda r: (r[2], r[0]))
        best = None
        for run_id, _, _, metric in seq:
            champ = best is None or metric > best[1]
            assert ref[run_id][0] == int(champ)
            if champ:
                assert ref[run_id][1] == (run_id if best is None else best[0])
                best = (run_id, metric)


def test_champion_replay_ties_and_null_metrics(spark):
    rows = [
        ("a", "tie", D, 0.5), ("b", "tie", D, 0.5), ("c", "tie", D + dt.timedelta(days=1), 0.9),
        ("d", "null", D, None), ("e", "null", D + dt.timedelta(hours=1), None),
        ("f", "null", D + dt.timedelta(days=2), 0.1), ("g", "null", D + dt.timedelta(days=3), float("nan")),
    ]
    runs = spark.createDataFrame(rows, "run_id string, model_name string, created timestamp_ntz, metric double")
    got = {r["run_id"]: (r["is_champion"], r["challenger_run_id"]) for r in champion_history(runs).collect()}
    assert got == {"a": (1, "a"), "b": (0, None), "c": (1, "a"),
                   "d": (1, "d"), "e": (0, None), "f": (1, "d"), "g": (0, None)}


def test_current_aliases_after_replay(spark):
    from featurewright.operators.history import current_aliases

    runs = spark.createDataFrame(
        [(str(i + 1), "m", D + dt.timedelta(days=i), v) for i, v in enumerate([0.5, 0.5, 0.7, 0.6, 0.8])],
        "run_id string, model_name string, created timestamp_ntz, metric double",
    )
    got = {r["alias"]: r["run_id"] for r in current_aliases(champion_history(runs)).collect()}
    assert got == {"Champion": "5", "Challenger": "3"}


def test_run_snapshot_columns(spark):
    from featurewright.operators.history import run_snapshot

    runs = spark.sql(
        "SELECT 'r1' AS run_id, 'e1' AS experiment_id, 'n' AS run_name, 'Champion' AS alias, 'm' AS model_name, "
        "'3' AS version, 1704067200123L AS created_ms, 1704067201123L AS updated_ms, "
        "map('recall', 0.9D) AS metrics, map('depth', '3') AS params, "
        "'{\"rows\": \"10\", \"cols\": \"4\"}' AS dataset_profile, 's3' AS dataset_source"
    )
    r = run_snapshot(runs, "2024-02-01 00:00:00").collect()[0]
    assert r["created_timestamp"] == "2024-01-01 00:00:00.123000"
    assert r["last_updated_timestamp"] == "2024-01-01 00:00:01.123000"
    assert r["dataset_profile"] == {"rows": "10", "cols": "4"}
    assert r["active_flag"] == "Y" and r["end_date"] is None and r["start_date"] == dt.date(2024, 1, 1)
    assert r["ingestion_time"] == dt.datetime(2024, 2, 1)


def test_latest_version_per_stage(spark):
    from featurewright.operators.history import latest_version

    models = spark.createDataFrame(
        [("m", "2", "Production"), ("m", "10", "Staging"), ("m", "9", "Production"), ("n", "1", "Staging")],
        "model_name string, version string, stage string",
    )
    assert {r["model_name"]: r["latest_version"] for r in latest_version(models).collect()} == {"m": 10, "n": 1}
    prod = latest_version(models, stage_col="stage", stage="Production").collect()
    assert [(r["model_name"], r["latest_version"]) for r in prod] == [("m", 9)]  # numeric, not string, max


def test_row_index_default_partitioning_matches_row_number(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("a"))  # a permutation-like order key
    got = row_index(df, ["a"], "id")  # no explicit count: AQE may coalesce the range shuffle
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("a")) - 1)
    j = got.join(want, "a")
    assert j.count() == 20000 and j.where("id != rn").count() == 0
