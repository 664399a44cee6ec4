"""Registered queries: trip features, time functions and window aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.functions.time import ceil_minutes, is_weekend, plus_months, year_month
from featurewright.operators.windows import filter_by_ts, sliding, tumbling
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.plans.trips import dropoff_features, pickup_features, scoring_input
from featurewright.sources.standins import trips

# DuckDB forms of the window rules, shared by several oracles.
PICKUP_SQL = f"""
  SELECT zip, w_end AS ts, strftime(w_end, '%Y-%m') AS yyyy_mm,
         {r_sql('CAST(avg(value) AS FLOAT)')} AS mean_fare_window_1h_pickup_zip,
         CAST(count(*) AS INTEGER) AS count_trips_window_1h_pickup_zip
  FROM (SELECT user_id AS zip, value,
               time_bucket(INTERVAL 15 MINUTE, ts) + to_minutes(15 * k) AS w_end
        FROM events CROSS JOIN (VALUES (1), (2), (3), (4)) r(k))
  GROUP BY zip, w_end
"""

DROPOFF_SQL = """
  SELECT zip, w_end AS ts, strftime(w_end, '%Y-%m') AS yyyy_mm,
         CAST(count(*) AS INTEGER) AS count_trips_window_30m_dropoff_zip,
         CASE WHEN isodow((w_end AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') >= 6
              THEN 1 ELSE 0 END AS dropoff_is_weekend
  FROM (SELECT user_id AS zip, time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS w_end
        FROM events)
  GROUP BY zip, w_end
"""


def ceil_sql(col: str, minutes: int) -> str:
    step = minutes * 60_000_000
    return f"make_timestamp(((epoch_us({col}) + {step - 1}) // {step}) * {step})"


@query("C3_pickup_features", PICKUP_SQL)
def c3_pickup(spark, sf_dir):
    """C3 (P1, A2, F1): 1 h / 15 min sliding mean and count per zip over all trips."""
    return rounded(pickup_features(trips(spark, sf_dir), "ts", zip_col="user_id", fare_col="value"))


@query("C3_pickup_features_presliced", PICKUP_SQL)
def c3_pickup_presliced(spark, sf_dir):
    """C3 through 15-minute pre-aggregated slices (same result, smaller shuffle)."""
    return rounded(
        pickup_features(trips(spark, sf_dir), "ts", zip_col="user_id", fare_col="value", presliced=True)
    )


@query("C2_dropoff_features", DROPOFF_SQL)
def c2_dropoff(spark, sf_dir):
    """C2 (P1, A1, F1, F2): 30-minute tumbling count and New York weekend flag."""
    return dropoff_features(trips(spark, sf_dir), "ts", zip_col="user_id")


@query(
    "C4_scoring_input",
    f"""
    SELECT event_id, user_id, event_type, props,
           {ceil_sql('ts', 15)} AS rounded_pickup_datetime,
           {ceil_sql('ts', 30)} AS rounded_dropoff_datetime
    FROM events
    """,
)
def c4_scoring_input(spark, sf_dir):
    """C4 (F3, F4, P9): rounded timestamps, raw timestamp and label dropped."""
    return scoring_input(trips(spark, sf_dir), "ts", "ts", "value")


@query(
    "P1_filter_by_ts",
    f"""
    SELECT event_id, ts, user_id, event_type, {r_sql('value')} AS value, props FROM events
    WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'
    """,
)
def p1_filter(spark, sf_dir):
    """Half-open time range [start, end) on the raw column (pushed to the scan)."""
    return rounded(filter_by_ts(trips(spark, sf_dir), "ts", "2024-01-08", "2024-01-15"))


@query(
    "A1_tumbling_counts",
    f"""
    SELECT event_type, w AS window_start, w + INTERVAL 30 MINUTE AS window_end,
           count(*) AS n, {r_sql('sum(value)')} AS total
    FROM (SELECT event_type, value, time_bucket(INTERVAL 30 MINUTE, ts) AS w FROM events)
    GROUP BY event_type, w
    """,
)
def a1_tumbling(spark, sf_dir):
    """A1: tumbling 30-minute count and sum per event type."""
    agg = tumbling(
        trips(spark, sf_dir), ["event_type"], "ts", "30 minutes",
        [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")],
    )
    return rounded(agg.select(
        "event_type", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "n", "total",
    ))


@query(
    "A2_sliding_stats",
    f"""
    SELECT event_type, w_end - INTERVAL 1 HOUR AS window_start, w_end AS window_end,
           count(*) AS n, {r_sql('avg(value)')} AS mean_value
    FROM (SELECT event_type, value, time_bucket(INTERVAL 15 MINUTE, ts) + to_minutes(15 * k) AS w_end
          FROM events CROSS JOIN (VALUES (1), (2), (3), (4)) r(k))
    GROUP BY event_type, w_end
    """,
)
def a2_sliding(spark, sf_dir):
    """A2: 1 h window sliding 15 min, count and mean per event type."""
    agg = sliding(
        trips(spark, sf_dir), ["event_type"], "ts", "1 hour", "15 minutes",
        [F.count(F.lit(1)).alias("n"), F.mean("value").alias("mean_value")],
    )
    return rounded(agg.select(
        "event_type", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "n", "mean_value",
    ))


@query(
    "F1_F3_time_functions",
    f"""
    SELECT event_id, strftime(ts, '%Y-%m') AS yyyy_mm,
           CASE WHEN isodow((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') >= 6
                THEN 1 ELSE 0 END AS is_weekend_ny,
           {ceil_sql('ts', 15)} AS ceil_15, {ceil_sql('ts', 60)} AS ceil_60,
           CAST(ts AS DATE) AS as_date,
           ts + INTERVAL 6 MONTH AS plus_6_months
    FROM events
    """,
)
def f_time(spark, sf_dir):
    """F1 year-month, F2 weekend in New York, F3 ceil to 15/60 minutes, F6, F7."""
    ev = trips(spark, sf_dir)
    return ev.select(
        "event_id",
        year_month("ts").alias("yyyy_mm"),
        is_weekend("ts").alias("is_weekend_ny"),
        ceil_minutes("ts", 15).alias("ceil_15"),
        ceil_minutes("ts", 60).alias("ceil_60"),
        F.to_date("ts").alias("as_date"),
        plus_months("ts", 6).alias("plus_6_months"),
    )
