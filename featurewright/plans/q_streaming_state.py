"""Registered queries: streams with keyed state, late rows and a restart.

The events are fed as four batches of files, in time order; after the second one
the query is stopped and started again from its checkpoint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from featurewright.plans.q_scoring import LINEAR_SQL, linear_model
from featurewright.plans.q_trips import DROPOFF_SQL, PICKUP_SQL
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.plans.training import DROPOFF_FEATURES, PICKUP_FEATURES
from featurewright.plans.trips import dropoff_features, pickup_features, round_trip_times
from featurewright.session import materialize, scratch_path
from featurewright.sources.standins import trips
from featurewright.sources.tables import read_table
from featurewright.streaming import late
from featurewright.streaming.features import fresh_paths, stream_source
from featurewright.streaming.keyed import StreamLookup, run_keyed_scoring_stream

#: Batches, and files of each.
BATCHES, FILES = 4, 4
MAX_AGE = "12 hours"
_AGE_US = 12 * 3_600_000_000


class Feed:
    """A folder that a stream reads ``FILES`` files a trigger from; batches are written one after the other."""

    def __init__(self, df, place):
        self.spark, self.df, self.place = df.sparkSession, df, place
        self.path = scratch_path(self.spark, "feed")

    def deliver(self, batch: int) -> None:
        self.df.where(self.place == batch).repartition(FILES).write.mode("append").parquet(self.path)

    def stream(self):
        return stream_source(self.spark, self.path, self.df.schema, max_files=FILES)


def _quarters(ev, ts: str):
    """Borders between the four quarters of the time span: one row on the driver."""
    lo, hi = ev.agg(F.min(ts), F.max(ts)).first()
    return [lo + (hi - lo) * i / BATCHES for i in range(1, BATCHES)] if lo is not None else []


def _quarter(column, cuts):
    return reduce(lambda n, c: n + F.when(F.col(column) >= F.lit(c), 1).otherwise(0), cuts, F.lit(0))


def _keyed_scores(spark, sf_dir, max_age=None):
    """Scores with features as of the rounded times, or, with an age limit, as of the event's own time."""
    ev = trips(spark, sf_dir)
    pickup = materialize(rounded(pickup_features(ev, "ts", zip_col="user_id", fare_col="value")))
    dropoff = materialize(dropoff_features(ev, "ts", zip_col="user_id"))
    events = round_trip_times(ev, "ts", "ts") if max_age is None else ev.withColumns({f"rounded_{side}_datetime": F.col("ts") for side in ("pickup", "dropoff")}).drop("ts")
    events = materialize(events.withColumn("asked", F.greatest("rounded_pickup_datetime", "rounded_dropoff_datetime")))
    cuts = _quarters(events, "asked")
    feeds = [Feed(events, _quarter("asked", cuts)), Feed(pickup, _quarter("ts", cuts)), Feed(dropoff, _quarter("ts", cuts))]
    out, ckpt = fresh_paths(spark, "r2-keyed")
    for batches in (range(0, 2), range(2, BATCHES)):
        for b in batches:
            for feed in feeds:
                feed.deliver(b)
        source, p, d = (feed.stream() for feed in feeds)
        lookups = [StreamLookup(p, PICKUP_FEATURES, "zip", "ts", "rounded_pickup_datetime"), StreamLookup(d, DROPOFF_FEATURES, "zip", "ts", "rounded_dropoff_datetime")]
        run_keyed_scoring_stream(source, "user_id", lookups, linear_model, out, ckpt, "1", "2024-02-01 00:00:00",
                                 exclude=["rounded_pickup_datetime", "rounded_dropoff_datetime", "asked"], fill=0.0, delay="2 days", max_age=max_age).awaitTermination()
    return rounded(spark.read.parquet(out).select("event_id", "user_id", "prediction", "model_version", "inference_timestamp"))


@query("R2_keyed_state_score", LINEAR_SQL)
def r2_keyed_state(spark, sf_dir):
    """R2 + S2: features kept per key in the state store; drained over four batches with a restart = the batch as-of scores."""
    return _keyed_scores(spark, sf_dir)


@query(
    "R2_keyed_state_max_age",
    f"""
    WITH p AS ({PICKUP_SQL}), d AS ({DROPOFF_SQL}),
    found AS (
      SELECT event_id, user_id, CASE WHEN epoch_us(e.ts) - epoch_us(p.ts) < {_AGE_US} THEN CAST(mean_fare_window_1h_pickup_zip AS DOUBLE) END AS m,
             CASE WHEN epoch_us(e.ts) - epoch_us(p.ts) < {_AGE_US} THEN count_trips_window_1h_pickup_zip END AS n,
             CASE WHEN epoch_us(e.ts) - epoch_us(d.ts) < {_AGE_US} THEN count_trips_window_30m_dropoff_zip END AS t,
             CASE WHEN epoch_us(e.ts) - epoch_us(d.ts) < {_AGE_US} THEN dropoff_is_weekend END AS w
      FROM events e ASOF LEFT JOIN p ON e.user_id = p.zip AND e.ts >= p.ts ASOF LEFT JOIN d ON e.user_id = d.zip AND e.ts >= d.ts)
    SELECT event_id, user_id, {r_sql('2.0 + 0.5 * ifnull(m, 0) + 0.25 * ifnull(n, 0) - 0.125 * ifnull(t, 0) + 1.5 * ifnull(w, 0)')} AS prediction,
           '1' AS model_version, TIMESTAMP '2024-02-01 00:00:00' AS inference_timestamp
    FROM found""",
)
def r2_keyed_state_max_age(spark, sf_dir):
    """R2: features of twelve hours and more are not used, and keys without newer ones leave the state."""
    return _keyed_scores(spark, sf_dir, max_age=MAX_AGE)


#: Events of this kind of the first quarter arrive with the third batch.
LATE_KIND = "error"
_DELIVERED_SQL = f"""
span AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
placed AS (SELECT events.*, CASE WHEN q = 0 AND event_type = '{LATE_KIND}' THEN 2 ELSE q END AS batch FROM (
  SELECT events.*, CAST(epoch_us(ts) >= epoch_us(lo) + (epoch_us(hi) - epoch_us(lo)) / 4 AS INTEGER)
         + CAST(epoch_us(ts) >= epoch_us(lo) + (epoch_us(hi) - epoch_us(lo)) / 2 AS INTEGER)
         + CAST(epoch_us(ts) >= epoch_us(lo) + (epoch_us(hi) - epoch_us(lo)) * 3 / 4 AS INTEGER) AS q FROM events, span) AS events),
latest AS (SELECT batch + 1 AS batch, max(max(ts)) OVER (ORDER BY batch) AS seen FROM placed GROUP BY batch),
marked AS (SELECT placed.*, seen - INTERVAL 2 DAY AS mark FROM placed LEFT JOIN latest USING (batch))"""


def _late_root(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    quarter = _quarter("ts", _quarters(ev, "ts"))
    feed = Feed(ev, F.when((quarter == 0) & (F.col("event_type") == LATE_KIND), 2).otherwise(quarter))
    root, ckpt = fresh_paths(spark, "r1-late")
    for batches in (range(0, 2), range(2, BATCHES)):
        for b in batches:
            feed.deliver(b)
        late.run_admitting_stream(feed.stream(), "ts", "user_id", "value", root, ckpt, delay="2 days").awaitTermination()
    return root


@query("R1_late_rows_features", f"WITH {_DELIVERED_SQL}, kept AS (FROM marked WHERE mark IS NULL OR ts >= mark) "
       + PICKUP_SQL.replace("FROM events CROSS JOIN", "FROM kept CROSS JOIN"))
def r1_late_features(spark, sf_dir):
    """A quarter's events of one kind come two batches late; windows hold what was admitted, through a restart."""
    return rounded(late.window_features(spark, _late_root(spark, sf_dir)))


@query("R1_late_rows_aside", f"WITH {_DELIVERED_SQL} SELECT event_id, ts, user_id, mark AS watermark, CAST(batch AS INTEGER) AS epoch FROM marked WHERE ts < mark")
def r1_late_aside(spark, sf_dir):
    """Exactly the rows behind the watermark, kept aside with the watermark that they missed."""
    rows = late.late_rows(spark, _late_root(spark, sf_dir))
    return rows.select("event_id", "ts", "user_id", "watermark", F.col("epoch").cast("int").alias("epoch"))
