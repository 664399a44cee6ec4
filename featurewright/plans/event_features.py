"""A feature module as a job names it: ``compute_features_fn`` over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from featurewright.plans.trips import dropoff_features, pickup_features


def compute_features_fn(input_df: DataFrame, timestamp_column: str, start_date: str | None, end_date: str | None) -> DataFrame:
    """Pickup window features per user."""
    return pickup_features(input_df, timestamp_column, start_date, end_date, zip_col="user_id", fare_col="value")


def compute_dropoff_features(input_df: DataFrame, timestamp_column: str, start_date: str | None, end_date: str | None) -> DataFrame:
    """Drop-off window features per user."""
    return dropoff_features(input_df, timestamp_column, start_date, end_date, zip_col="user_id")
