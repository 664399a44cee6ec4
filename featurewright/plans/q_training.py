"""Registered queries: as-of lookups and the training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.operators.asof import NESTED_BUCKETS, Lookup, asof_lookup
from featurewright.plans.q_trips import DROPOFF_SQL, PICKUP_SQL, ceil_sql
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.plans.training import events_training_set
from featurewright.plans.trips import dropoff_features
from featurewright.sources.standins import trips

TRAINING_SQL = f"""
WITH p AS ({PICKUP_SQL}), d AS ({DROPOFF_SQL}),
base AS (
  SELECT event_id, user_id, event_type, value, props,
         {ceil_sql('ts', 15)} AS rp, {ceil_sql('ts', 30)} AS rd
  FROM events)
SELECT base.event_id, base.user_id, base.event_type, {r_sql('base.value')} AS value, base.props,
       p.mean_fare_window_1h_pickup_zip, p.count_trips_window_1h_pickup_zip,
       d.count_trips_window_30m_dropoff_zip, d.dropoff_is_weekend
FROM base
ASOF LEFT JOIN p ON base.user_id = p.zip AND base.rp >= p.ts
ASOF LEFT JOIN d ON base.user_id = d.zip AND base.rd >= d.ts
"""


@query("J6_training_set", TRAINING_SQL)
def j6_training_set(spark, sf_dir):
    """J6 (J5 x2, F3, F4, P9): every event + pickup and drop-off features as of the rounded times."""
    return rounded(events_training_set(trips(spark, sf_dir)))


@query(
    "J5_asof_lookup_raw_ts",
    f"""
    WITH d AS ({DROPOFF_SQL})
    SELECT v.event_id, v.ts, v.user_id, v.event_type, {r_sql('v.value')} AS value, v.props,
           d.count_trips_window_30m_dropoff_zip, d.dropoff_is_weekend
    FROM events v
    ASOF LEFT JOIN d ON v.user_id = d.zip AND v.ts >= d.ts
    """,
)
def j5_asof_raw(spark, sf_dir):
    """J5 on unrounded probe times: each event gets the latest 30-minute count at or before it."""
    ev = trips(spark, sf_dir)
    feats = dropoff_features(ev, "ts", zip_col="user_id")
    lk = Lookup(feats, ["count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"],
                ["user_id"], "ts", table_key=["zip"], table_ts="ts")
    return rounded(asof_lookup(ev, lk, bucket=("1 day", "1 hour")))


@query(
    "J5_asof_lookup_embargo",
    f"""
    WITH p AS ({PICKUP_SQL})
    SELECT v.event_id, v.user_id, {r_sql('v.value')} AS value,
           p.mean_fare_window_1h_pickup_zip, p.count_trips_window_1h_pickup_zip
    FROM (SELECT event_id, user_id, value, {ceil_sql('ts', 15)} AS rp
          FROM events) v
    ASOF LEFT JOIN p ON v.user_id = p.zip AND v.rp >= p.ts + INTERVAL 15 MINUTE
    """,
)
def j5_asof_embargo(spark, sf_dir):
    """J5 with a 15-minute embargo: a window is usable only 15 minutes after it closes."""
    from featurewright.functions.time import ceil_minutes
    from featurewright.plans.trips import pickup_features

    ev = trips(spark, sf_dir)
    feats = pickup_features(ev, "ts", zip_col="user_id", fare_col="value")
    base = ev.select(
        "event_id", "user_id", "value", ceil_minutes("ts", 15).alias("rp")
    )
    lk = Lookup(feats, ["mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"],
                ["user_id"], "rp", table_key=["zip"], table_ts="ts")
    return rounded(asof_lookup(base, lk, embargo="15 minutes").drop("rp"))


@query(
    "J5_asof_lookup_single_hot_key",
    f"""
    WITH d AS (
      SELECT w_end AS ts, CAST(count(*) AS INTEGER) AS n_events_30m
      FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS w_end FROM events)
      GROUP BY w_end)
    SELECT e.event_id, e.ts, d.n_events_30m
    FROM (SELECT event_id, ts, 0 AS k FROM events) e
    ASOF LEFT JOIN (SELECT 0 AS k, * FROM d) d2 ON e.k = d2.k AND e.ts >= d2.ts
    LEFT JOIN d ON d.ts = d2.ts
    """,
)
def j5_asof_hot_key(spark, sf_dir):
    """J5 under total skew: one key holds every row; nested buckets keep windows small."""
    from featurewright.operators.windows import tumbling

    ev = trips(spark, sf_dir).select("event_id", "ts", F.lit(0).alias("k"))
    counts = tumbling(ev, ["k"], "ts", "30 minutes", [F.count(F.lit(1)).cast("int").alias("n_events_30m")])
    feats = counts.select("k", F.col("window.end").alias("ts"), "n_events_30m")
    lk = Lookup(feats, ["n_events_30m"], ["k"], "ts")
    out = asof_lookup(ev, lk, bucket=NESTED_BUCKETS)
    return out.select("event_id", "ts", "n_events_30m")
