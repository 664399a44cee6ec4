"""Remaining small operators: sinks, all-null drop, packing, entity scan, streaming drain."""

import datetime as dt
import os

from pyspark.sql import functions as F

from featurewright.operators.history import pack_features, stamp
from featurewright.plans.customer import drop_all_null_columns
from featurewright.plans.trips import pickup_features
from featurewright.session import scratch_path
from featurewright.sources import sinks
from featurewright.sources.tables import scan
from featurewright.streaming.features import fresh_paths, run_feature_stream, stream_pickup_features, stream_source


def test_drop_all_null_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "k int, x double, s string")
    assert drop_all_null_columns(df).columns == ["k", "s"]


def test_pack_and_stamp(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "k int, x double, s string")
    row = stamp(pack_features(df, ["x", "s"]), 7, "2024-01-01 00:00:00").collect()[0]
    assert row["features"]["x"] == 2.0 and row["features"]["s"] == "a"
    assert row["model_version"] == "7"


def test_scan_entity_and_since(spark):
    df = spark.createDataFrame(
        [("DE", dt.datetime(2011, 1, 1)), ("DE", dt.datetime(2010, 12, 31)), ("FR", dt.datetime(2012, 1, 1))],
        "CountryCode string, InvoiceDate timestamp_ntz",
    )
    assert scan(df, entity_col="CountryCode", entity="DE", ts_col="InvoiceDate", since="2011-01-01").count() == 1


def test_refresh_rewrite_create_with_id(spark):
    name = f"fw_test_db.t_{os.getpid()}"
    spark.sql("CREATE DATABASE IF NOT EXISTS fw_test_db")
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "k string, v double")
    sinks.create_with_id(spark, name, df, ["k"])
    assert [(r["id"], r["k"]) for r in spark.table(name).orderBy("id").collect()] == [(0, "a"), (1, "b")]
    # rewrite from a frame derived from the table itself (staged first)
    derived = spark.table(name).withColumn("v", F.col("v") * 10)
    sinks.rewrite(spark, name, derived)
    assert sorted(r["v"] for r in spark.table(name).collect()) == [10.0, 20.0]
    sinks.refresh(spark, name, spark.createDataFrame([(5, "z", 0.5)], "id bigint, k string, v double"))
    assert [r["k"] for r in spark.table(name).collect()] == ["z"]


def test_stream_drain_equals_batch(spark):
    src_dir = scratch_path(spark, "stream-src")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=7 * i), i % 3, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, value double")
    df.write.parquet(src_dir)
    feats = stream_pickup_features(stream_source(spark, src_dir, df.schema), "ts", "user_id", "value")
    table, ckpt = fresh_paths(spark, "t-r1")
    run_feature_stream(feats, table, ["zip", "ts"], ckpt).awaitTermination()
    got = spark.read.parquet(table).select("zip", "ts", "count_trips_window_1h_pickup_zip")
    want = pickup_features(df, "ts", zip_col="user_id", fare_col="value").select(
        "zip", "ts", "count_trips_window_1h_pickup_zip")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_stream_late_rows_dropped_on_time_rows_upserted(spark):
    src_dir = scratch_path(spark, "stream-late")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    first = spark.createDataFrame(
        [(i, t0 + dt.timedelta(minutes=10 * i), 1, 1.0) for i in range(13)], schema)  # 10:00 .. 12:00
    first.write.mode("append").parquet(src_dir)
    feats_src = stream_source(spark, src_dir, first.schema)
    table, ckpt = fresh_paths(spark, "t-late")

    def drain():
        feats = stream_pickup_features(feats_src, "ts", "user_id", "value", watermark="30 minutes")
        run_feature_stream(feats, table, ["zip", "ts"], ckpt).awaitTermination()

    drain()
    before = {r["ts"]: r["count_trips_window_1h_pickup_zip"] for r in spark.read.parquet(table).collect()}
    # second micro-batch: one row far behind the watermark (11:30), one on time (12:05)
    spark.createDataFrame([(100, dt.datetime(2024, 1, 1, 9, 5), 1, 1.0),
                           (101, dt.datetime(2024, 1, 1, 12, 5), 1, 1.0)], schema) \
        .write.mode("append").parquet(src_dir)
    drain()
    table_df = spark.read.parquet(table)
    after = {r["ts"]: r["count_trips_window_1h_pickup_zip"] for r in table_df.collect()}
    assert dt.datetime(2024, 1, 1, 9, 15) not in after  # the late 09:05 row opened no window
    assert after[dt.datetime(2024, 1, 1, 12, 15)] == before[dt.datetime(2024, 1, 1, 12, 15)] + 1
    assert table_df.count() == table_df.select("zip", "ts").distinct().count()  # upsert kept one row per key


def test_model_udf_over_struct(spark):
    from featurewright.operators.models import score_struct

    class _LinearModel:  # defined locally: shipped to the workers by value
        """A plain Python model: y = 2 * a - b + 1."""

        def predict(self, X):
            return 2 * X["a"] - X["b"] + 1

    df = spark.createDataFrame([(1, 1.0, 0.5), (2, 3.0, 1.0)], "k int, a double, b double")
    out = {r["k"]: r["prediction"] for r in score_struct(df, _LinearModel().predict, ["a", "b"]).collect()}
    assert out == {1: 2.5, 2: 6.0}


def test_csv_schema_inferred_once(spark):
    from featurewright.sources.tables import infer_csv_schema, read_listing_csv, schema_from_json

    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, 'a "quoted"\nline', 2.5), (2, "plain", 3.0)], "id int, txt string, v double")
    df.write.option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    text = infer_csv_schema(spark, path)
    back = read_listing_csv(spark, path, schema=schema_from_json(text))
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["int", "string", "double"]
    assert sorted(back.collect()) == sorted(df.collect())


def test_refresh_from_own_table(spark):
    name = f"fw_test_db.refresh_{os.getpid()}"
    spark.sql("CREATE DATABASE IF NOT EXISTS fw_test_db")
    spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double").write.saveAsTable(name)
    sinks.refresh(spark, name, spark.table(name).withColumn("v", F.col("v") + 1))
    assert sorted(r["v"] for r in spark.table(name).collect()) == [2.0, 3.0]


def test_stack_by_position_and_by_name(spark):
    from featurewright.operators.history import stack, stack_by_name

    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y")], "key int, val string")
    c = spark.createDataFrame([(3, "z")], "kk int, vv string")
    s = stack([a, b, c])
    assert s.columns == ["k", "v"] and sorted(s.collect()) == [(1, "x"), (2, "y"), (3, "z")]
    n = stack_by_name(a, spark.createDataFrame([(4,)], "k int"))
    assert sorted((r["k"], r["v"]) for r in n.collect()) == [(1, "x"), (4, None)]


def test_scalar_helpers(spark):
    from featurewright.functions import json_map, match_any, squash_blanks, trunc_nullable_int

    df = spark.createDataFrame([("cat_a", '{"k": "1"}', "a b c", 2.9), ("dog", None, None, None)],
                               "name string, js string, s string, x double")
    r = df.select(match_any("name", [" cat_ ", "", "bird"]).alias("m"), json_map("js").alias("j"),
                  squash_blanks("s").alias("s"), trunc_nullable_int("x").alias("x")).collect()
    assert [row["m"] for row in r] == [True, False]
    assert r[0]["j"] == {"k": "1"} and r[1]["j"] is None
    assert r[0]["s"] == "a_b_c" and r[1]["s"] is None  # null-safe, unlike the original lambda
    assert r[0]["x"] == 2 and r[1]["x"] is None
