"""Point-in-time training set over the trip feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from featurewright.operators.asof import Lookup, training_set
from featurewright.plans.trips import dropoff_features, pickup_features, round_trip_times
from featurewright.session import materialize

PICKUP_FEATURES = ("mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip")
DROPOFF_FEATURES = ("count_trips_window_30m_dropoff_zip", "dropoff_is_weekend")


def trip_lookups(
    pickup_table: DataFrame,
    dropoff_table: DataFrame,
    pickup_zip: str = "pickup_zip",
    dropoff_zip: str = "dropoff_zip",
    table_ts: str = "ts",
) -> list[Lookup]:
    return [
        Lookup(pickup_table, PICKUP_FEATURES, [pickup_zip], "rounded_pickup_datetime",
               table_key=["zip"], table_ts=table_ts),
        Lookup(dropoff_table, DROPOFF_FEATURES, [dropoff_zip], "rounded_dropoff_datetime",
               table_key=["zip"], table_ts=table_ts),
    ]


def trip_training_set(
    trips: DataFrame,
    pickup_table: DataFrame,
    dropoff_table: DataFrame,
    pickup_col: str = "tpep_pickup_datetime",
    dropoff_col: str = "tpep_dropoff_datetime",
    pickup_zip: str = "pickup_zip",
    dropoff_zip: str = "dropoff_zip",
    label: str = "fare_amount",
    table_ts: str = "ts",
    embargo: str | None = None,
) -> DataFrame:
    """Round trip times, look both feature tables up as of them, drop the rounded columns."""
    base = round_trip_times(trips, pickup_col, dropoff_col)
    return training_set(
        base,
        trip_lookups(pickup_table, dropoff_table, pickup_zip, dropoff_zip, table_ts),
        label=label,
        exclude_columns=["rounded_pickup_datetime", "rounded_dropoff_datetime"],
        embargo=embargo,
    )


def events_training_set(events: DataFrame, embargo: str | None = None) -> DataFrame:
    """The stand-in form: events are the trips, ``user_id`` both zips, ``value`` the fare."""
    # The pipeline writes feature tables before training; the checkpoint plays that
    # role, so each lookup scans a table instead of recomputing the window aggregate.
    pickup = materialize(pickup_features(events, "ts", zip_col="user_id", fare_col="value"))
    dropoff = materialize(dropoff_features(events, "ts", zip_col="user_id"))
    return trip_training_set(
        events, pickup, dropoff, "ts", "ts", "user_id", "user_id", "value", "ts", embargo
    )
