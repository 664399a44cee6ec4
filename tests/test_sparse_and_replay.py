"""Sparse preprocessing at any number of levels, dotted names, class weights, replay-safe scoring, entity filter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featurewright.operators.asof import Lookup
from featurewright.operators.models import balanced_weights
from featurewright.operators.prep import PrepConfig, Preprocessor, SparsePreprocessor
from featurewright.plans.customer import CustomerConfig, customer_features
from featurewright.plans.registry import stable_round
from featurewright.streaming.features import fresh_paths, score_into_path


def test_more_than_ten_thousand_levels_fit(spark):
    df = spark.range(10_001).select("id", F.concat(F.lit("L"), "id").alias("city"))
    fit = SparsePreprocessor(PrepConfig((), ["city"], None, keep_cols=["id"])).fit(df)
    out = fit.transform(df)
    assert fit.levels.count() == 10_000  # the first level is dropped
    assert out.count() == 10_000 and out.select("feature").distinct().count() == 10_000


def test_sparse_equals_wide(spark):
    rows = [(i, float(i % 7) if i % 5 else None, ["a", "St. Louis", "b`c", None][i % 4]) for i in range(80)]
    df = spark.createDataFrame(rows, "k int, `x.y` double, `home town` string")
    cfg = PrepConfig(["x.y"], ["home town"], 0.0001, keep_cols=["k"])
    wide = Preprocessor(cfg).fit(df).transform(df)
    want = {(r["k"], c, v) for r in wide.collect() for c, v in r.asDict().items() if c != "k" and v != 0}
    got = [tuple(r) for r in SparsePreprocessor(cfg).fit(df).transform(df).select("k", "feature", "value").collect()]
    assert set(got) == want and len(got) == len(want)
    assert "home town_St. Louis" in wide.columns


def test_sparse_unseen_level_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    cfg = PrepConfig((), ["s"], None, keep_cols=["k"])
    fit = SparsePreprocessor(cfg).fit(df)
    assert fit.transform(spark.createDataFrame([(3, "new")], "k int, s string")).count() == 0
    empty = df.where("false")
    assert SparsePreprocessor(cfg).fit(empty).transform(df).count() == 0


def test_balanced_weights_sum_to_rows(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2 + [(None,)], "y int")
    rows = balanced_weights(df, "y").collect()
    assert sum(r["weight"] for r in rows) == pytest.approx(8) and len(rows) == 8


def test_scoring_batch_retried_is_written_once(spark):
    t = dt.datetime(2024, 1, 1)
    feats = spark.createDataFrame([(1, t, 2.0)], "zip bigint, ts timestamp_ntz, f double")
    base = spark.createDataFrame([(7, 1, t), (8, 2, t)], "id int, zip bigint, t timestamp_ntz")
    out, _ = fresh_paths(spark, "replay")
    run = score_into_path([Lookup(feats, ["f"], ["zip"], "t", table_ts="ts")], lambda x: x["f"] * 10, out, "1",
                          "2024-02-01 00:00:00")
    run(base, 0)
    run(base, 0)
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    assert got == {7: 20.0, 8: None} and spark.read.parquet(out).count() == 2


def test_entity_filter_needs_its_column(spark):
    s = spark.createDataFrame([], "ContactCode bigint, InvoiceDate timestamp_ntz")
    with pytest.raises(ValueError, match="sales has no column CountryCode"):
        customer_features(s, s, s, CustomerConfig(entity="DE"))


def test_rounding_of_large_values(spark):
    row = spark.createDataFrame([(1e16, 3e15, -1.23456, None)], "a double, b double, c double, d double").select(
        *[stable_round(F.col(c)).alias(c) for c in "abcd"]).first()
    assert tuple(row) == (1e16, 3e15, -1.2346, None)
