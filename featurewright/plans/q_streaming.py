"""Registered queries: streaming feature and scoring jobs, drained with availableNow."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.plans.q_scoring import LINEAR_SQL, linear_model
from featurewright.plans.q_trips import DROPOFF_SQL, PICKUP_SQL
from featurewright.plans.registry import query, rounded
from featurewright.session import materialize, scratch_path
from featurewright.sources.tables import read_table
from featurewright.streaming.features import (
    fresh_paths,
    run_feature_stream,
    run_scoring_stream,
    stream_dropoff_features,
    stream_pickup_features,
    stream_source,
)


def _events_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return stream_source(spark, sf_dir, schema, glob="events.parquet")


@query("R1_stream_pickup_features", PICKUP_SQL)
def r1_stream_pickup(spark, sf_dir):
    """C3 as a watermarked update-mode stream upserted into a feature table; drained = batch."""
    feats = stream_pickup_features(_events_stream(spark, sf_dir), "ts", "user_id", "value")
    table, ckpt = fresh_paths(spark, "r1-pickup")
    q = run_feature_stream(feats, table, ["zip", "ts"], ckpt)
    q.awaitTermination()
    return rounded(spark.read.parquet(table).select(
        "zip", "ts", "yyyy_mm", "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"
    ))


@query("R1_stream_dropoff_features", DROPOFF_SQL)
def r1_stream_dropoff(spark, sf_dir):
    """C2 as a stream (30-minute tumbling count, weekend flag)."""
    feats = stream_dropoff_features(_events_stream(spark, sf_dir), "ts", "user_id")
    table, ckpt = fresh_paths(spark, "r1-dropoff")
    q = run_feature_stream(feats, table, ["zip", "ts"], ckpt)
    q.awaitTermination()
    return spark.read.parquet(table).select(
        "zip", "ts", "yyyy_mm", "count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"
    )


@query("R2_stream_score")
def r2_stream_score(spark, sf_dir):
    """R2: the stream of events scored in foreachBatch with as-of features and a fitted model."""
    from featurewright.operators.models import train_forest_regressor
    from featurewright.plans.q_models import TRIP_FEATURES, _trip_sets
    from featurewright.plans.training import trip_lookups
    from featurewright.plans.trips import dropoff_features, pickup_features, round_trip_times
    from featurewright.sources.standins import trips

    ev = trips(spark, sf_dir)
    data = _trip_sets(spark, sf_dir)
    model = train_forest_regressor(data.where(F.col("split") == "train"), TRIP_FEATURES, "value", trees=20)
    # Static feature tables: materialized once, not recomputed in every micro-batch.
    lookups = trip_lookups(
        materialize(pickup_features(ev, "ts", zip_col="user_id", fare_col="value")),
        materialize(dropoff_features(ev, "ts", zip_col="user_id")), "user_id", "user_id",
    )
    src = round_trip_times(_events_stream(spark, sf_dir), "ts", "ts").drop("value")
    out, ckpt = fresh_paths(spark, "r2-scores")
    q = run_scoring_stream(src, lookups, model, out, ckpt, "1", "2024-02-01 00:00:00",
                           exclude=["rounded_pickup_datetime", "rounded_dropoff_datetime"], fill=0.0)
    q.awaitTermination()
    return spark.read.parquet(out).drop("epoch")


def _drained_in_batches(spark, sf_dir, run, parts: int = 4):
    """The events in time order, as many micro-batches as ``parts`` however long the table is.

    ``run(stream)`` starts a query on the folder; it is drained after each part has been written there.
    """
    ev = read_table(spark, sf_dir, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    path = scratch_path(spark, "event-files")
    cuts = [lo + (hi - lo) * i / parts for i in range(1, parts)]
    for start, end in zip([None, *cuts], [*cuts, None]):
        part = ev.where((F.lit(True) if start is None else F.col("ts") >= F.lit(start))
                        & (F.lit(True) if end is None else F.col("ts") < F.lit(end)))
        part.write.mode("append").parquet(path)
        run(stream_source(spark, path, ev.schema)).awaitTermination()


@query("R1_stream_many_batches", PICKUP_SQL)
def r1_stream_many_batches(spark, sf_dir):
    """R1 over several micro-batches: windows that span a batch border are merged, the drained table = batch."""
    table, ckpt = fresh_paths(spark, "r1-batches")
    _drained_in_batches(spark, sf_dir, lambda events: run_feature_stream(
        stream_pickup_features(events, "ts", "user_id", "value", watermark="2 days"), table, ["zip", "ts"], ckpt))
    return rounded(spark.read.parquet(table).select(
        "zip", "ts", "yyyy_mm", "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"
    ))


@query("R2_stream_linear_score", LINEAR_SQL)
def r2_stream_linear_score(spark, sf_dir):
    """R2 with a fixed linear model over several micro-batches: the drained scores = batch scores."""
    from featurewright.plans.training import trip_lookups
    from featurewright.plans.trips import dropoff_features, pickup_features, round_trip_times
    from featurewright.sources.standins import trips

    ev = trips(spark, sf_dir)
    lookups = trip_lookups(
        materialize(rounded(pickup_features(ev, "ts", zip_col="user_id", fare_col="value"))),
        materialize(dropoff_features(ev, "ts", zip_col="user_id")), "user_id", "user_id",
    )
    out, ckpt = fresh_paths(spark, "r2-linear")
    _drained_in_batches(spark, sf_dir, lambda events: run_scoring_stream(
        round_trip_times(events, "ts", "ts"), lookups, linear_model, out, ckpt, "1", "2024-02-01 00:00:00",
        exclude=["rounded_pickup_datetime", "rounded_dropoff_datetime"], fill=0.0))
    return rounded(spark.read.parquet(out).select("event_id", "user_id", "prediction", "model_version",
                                                  "inference_timestamp"))
