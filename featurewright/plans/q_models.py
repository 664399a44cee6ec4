"""Registered queries: training and scoring (rows-only: results depend on the fitted model)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.functions.scalar import bucket
from featurewright.operators.models import (
    BoostParams,
    score,
    score_with_lookup,
    train_bucket_classifier,
    train_fare_regressor,
    train_forest_regressor,
    train_logistic,
)
from featurewright.operators.prep import PrepConfig, Preprocessor, split
from featurewright.plans.customer import customer_features
from featurewright.plans.q_customer import CFG, _sources
from featurewright.plans.registry import query
from featurewright.plans.training import PICKUP_FEATURES, DROPOFF_FEATURES, events_training_set, trip_lookups
from featurewright.plans.trips import dropoff_features, pickup_features, round_trip_times
from featurewright.session import materialize
from featurewright.sources.standins import CATEGORICAL_FEATURES, NUMERIC_FEATURES, VALUE_BUCKETS, trips

TRIP_FEATURES = [*PICKUP_FEATURES, *DROPOFF_FEATURES]


def _customer_sets(spark, sf_dir):
    """C1 -> closed-window rows -> keyed split -> preprocessing fitted on train only."""
    feats = customer_features(*_sources(spark, sf_dir), CFG)
    rows = feats.where(F.col("repurchase_window_passed") == 1).withColumn(
        "value_bucket", bucket(F.coalesce(F.col("lifetime_value"), F.lit(0)), VALUE_BUCKETS)
    )
    rows = materialize(split(rows, "ContactCode", 0.3))
    keep = ("ContactCode", "split", "repurchase_flag", "value_bucket")
    fitted = Preprocessor(PrepConfig(NUMERIC_FEATURES, CATEGORICAL_FEATURES, 0.0001, keep_cols=keep)).fit(
        rows.where(F.col("split") == "train")
    )
    data = fitted.transform(rows)
    return data, fitted.kept


@query("L7_S1_logistic_repurchase")
def l7_logistic(spark, sf_dir):
    """L7 + S1: balanced logistic regression on the repurchase flag; test-split predictions."""
    data, feats = _customer_sets(spark, sf_dir)
    model = train_logistic(data.where(F.col("split") == "train"), feats, "repurchase_flag")
    return score(data.where(F.col("split") == "test"), model, keep=["ContactCode", "repurchase_flag"])


@query("L8_S1_bucket_classifier")
def l8_bucket_classifier(spark, sf_dir):
    """L8 + S1: one-vs-rest boosted trees over the 5 lifetime-value classes (raw scores kept)."""
    data, feats = _customer_sets(spark, sf_dir)
    model = train_bucket_classifier(data.where(F.col("split") == "train"), feats, "value_bucket", BoostParams())
    return score(data.where(F.col("split") == "test"), model, keep=["ContactCode", "value_bucket"],
                 raw_scores=True)


def _trip_sets(spark, sf_dir):
    ts = events_training_set(trips(spark, sf_dir))
    ts = split(ts.fillna(0.0, subset=TRIP_FEATURES).fillna(0, subset=TRIP_FEATURES), "event_id", 0.3)
    return materialize(ts)


@query("L9_S1_fare_regressor")
def l9_fare_regressor(spark, sf_dir):
    """L9 + S1: boosted regression (100 rounds, depth 5) of the fare on the looked-up features."""
    data = _trip_sets(spark, sf_dir)
    model = train_fare_regressor(data.where(F.col("split") == "train"), TRIP_FEATURES, "value")
    return score(data.where(F.col("split") == "test"), model, keep=["event_id", "value"])


@query("L10_S1_forest_regressor")
def l10_forest_regressor(spark, sf_dir):
    """L10 + S1: random forest regression (100 trees, depth 5)."""
    data = _trip_sets(spark, sf_dir)
    model = train_forest_regressor(data.where(F.col("split") == "train"), TRIP_FEATURES, "value")
    return score(data.where(F.col("split") == "test"), model, keep=["event_id", "value"])


@query("S2_score_with_lookup")
def s2_score_with_lookup(spark, sf_dir):
    """Events scored with automatic as-of feature lookup, stamped with model version and time."""
    ev = trips(spark, sf_dir)
    data = _trip_sets(spark, sf_dir)
    model = train_forest_regressor(data.where(F.col("split") == "train"), TRIP_FEATURES, "value", trees=20)
    pickup = materialize(pickup_features(ev, "ts", zip_col="user_id", fare_col="value"))
    dropoff = materialize(dropoff_features(ev, "ts", zip_col="user_id"))
    base = round_trip_times(ev, "ts", "ts").drop("value")
    return score_with_lookup(
        base, trip_lookups(pickup, dropoff, "user_id", "user_id"), model, "1", "2024-02-01 00:00:00",
        exclude=["rounded_pickup_datetime", "rounded_dropoff_datetime"], fill=0.0,
    )
