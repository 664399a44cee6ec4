"""Trip features: the reference's two unit tests plus hand-computed boundaries (FIXTURES.md)."""

import datetime as dt

from featurewright.functions.time import ceil_minutes
from featurewright.operators.windows import filter_by_ts
from featurewright.plans.trips import dropoff_features, pickup_features, round_trip_times

SCHEMA = ("tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
          "{zip} bigint, trip_distance bigint, fare_amount bigint")


def _trip(spark, when, zip_col):
    return spark.createDataFrame([(when, when, 94400, 2, 100)], SCHEMA.format(zip=zip_col))


def test_dropoff_one_row(spark):
    df = _trip(spark, dt.datetime(2022, 1, 10), "dropoff_zip")
    out = dropoff_features(df, "tpep_dropoff_datetime", "2022-01-01", "2022-01-15").collect()
    assert len(out) == 1
    r = out[0]
    assert r["tpep_dropoff_datetime"] == dt.datetime(2022, 1, 10, 0, 30)
    assert r["count_trips_window_30m_dropoff_zip"] == 1
    assert r["dropoff_is_weekend"] == 1  # Sunday evening in New York
    assert r["yyyy_mm"] == "2022-01"


def test_pickup_four_rows(spark):
    df = _trip(spark, dt.datetime(2022, 1, 12), "pickup_zip")
    out = pickup_features(df, "tpep_pickup_datetime", "2022-01-01", "2022-01-15").orderBy(
        "tpep_pickup_datetime").collect()
    assert len(out) == 4
    ends = [r["tpep_pickup_datetime"] for r in out]
    assert ends == [dt.datetime(2022, 1, 12, 0, m) for m in (15, 30, 45)] + [dt.datetime(2022, 1, 12, 1, 0)]
    assert all(r["mean_fare_window_1h_pickup_zip"] == 100.0 for r in out)
    assert all(r["count_trips_window_1h_pickup_zip"] == 1 for r in out)
    assert {r["yyyy_mm"] for r in out} == {"2022-01"}


def test_presliced_equals_direct(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = pickup_features(ev, "ts", zip_col="user_id", fare_col="value")
    b = pickup_features(ev, "ts", zip_col="user_id", fare_col="value", presliced=True)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_ceil_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 0, 0),), (dt.datetime(2024, 1, 1, 10, 0, 0, 1),),
            (dt.datetime(2024, 1, 1, 10, 59, 59),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r[0] for r in df.select(ceil_minutes("t", 15)).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 15), dt.datetime(2024, 1, 1, 11, 0)]


def test_time_filter_half_open(spark):
    rows = [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 3),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert filter_by_ts(df, "t", "2024-01-01", "2024-01-03").count() == 2
    assert filter_by_ts(df, "t", "", "2024-01-03").count() == 2  # empty bound = no bound
    assert filter_by_ts(df, "t", "2024-01-02", None).count() == 2


def test_round_trip_times_drops_originals(spark):
    df = _trip(spark, dt.datetime(2022, 1, 12, 0, 7), "pickup_zip")
    out = round_trip_times(df).collect()[0].asDict()
    assert "tpep_pickup_datetime" not in out and "tpep_dropoff_datetime" not in out
    assert out["rounded_pickup_datetime"] == dt.datetime(2022, 1, 12, 0, 15)
    assert out["rounded_dropoff_datetime"] == dt.datetime(2022, 1, 12, 0, 30)


def test_pushdown_reaches_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = filter_by_ts(ev, "ts", "2024-01-08", "2024-01-15").select("ts", "value")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan
