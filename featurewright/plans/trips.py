"""Trip feature tables and scoring input.

Feature functions follow the reference contract
``(input_df, timestamp_column, start, end) -> DataFrame`` and are kept in a
plain registry so a job can pick one by name.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurewright.functions.time import ceil_minutes, is_ntz, is_weekend, year_month
from featurewright.operators.windows import (
    filter_by_ts,
    sliding,
    sliding_mean_count_presliced,
    tumbling,
)


def pickup_features(
    df: DataFrame,
    ts_col: str,
    start=None,
    end=None,
    zip_col: str = "pickup_zip",
    fare_col: str = "fare_amount",
    presliced: bool = False,
) -> DataFrame:
    """1-hour window sliding every 15 minutes, stamped with the window end.

    Columns: zip, <ts_col>, yyyy_mm, mean_fare_window_1h_pickup_zip (float),
    count_trips_window_1h_pickup_zip (int).  Key: (zip, ts).
    """
    src = filter_by_ts(df, ts_col, start, end)
    if presliced:
        agg = sliding_mean_count_presliced(src, [zip_col], ts_col, fare_col, 4, 15)
        end_col = F.col("window_end")
        mean = F.try_divide(F.col("sum_v"), F.col("n_value"))
        count = F.col("n")
    else:
        agg = sliding(
            src, [zip_col], ts_col, "1 hour", "15 minutes",
            [F.mean(fare_col).alias("m"), F.count(F.lit(1)).alias("n")],
        )
        end_col = F.col("window.end")
        mean = F.col("m")
        count = F.col("n")
    return agg.select(
        F.col(zip_col).alias("zip"),
        end_col.alias(ts_col),
        year_month(end_col).alias("yyyy_mm"),
        mean.cast("float").alias("mean_fare_window_1h_pickup_zip"),
        count.cast("int").alias("count_trips_window_1h_pickup_zip"),
    )


def dropoff_features(
    df: DataFrame,
    ts_col: str,
    start=None,
    end=None,
    zip_col: str = "dropoff_zip",
    tz: str = "America/New_York",
) -> DataFrame:
    """30-minute tumbling count, window end, month id and weekend flag.

    Columns: zip, <ts_col>, yyyy_mm, count_trips_window_30m_dropoff_zip (int),
    dropoff_is_weekend (int).  Key: (zip, ts).
    """
    src = filter_by_ts(df, ts_col, start, end)
    agg = tumbling(src, [zip_col], ts_col, "30 minutes", [F.count(F.lit(1)).alias("n")])
    end_col = F.col("window.end")
    return agg.select(
        F.col(zip_col).alias("zip"),
        end_col.alias(ts_col),
        year_month(end_col).alias("yyyy_mm"),
        F.col("n").cast("int").alias("count_trips_window_30m_dropoff_zip"),
        is_weekend(end_col, tz).alias("dropoff_is_weekend"),
    )


def round_trip_times(
    df: DataFrame,
    pickup_col: str = "tpep_pickup_datetime",
    dropoff_col: str = "tpep_dropoff_datetime",
    pickup_minutes: int = 15,
    dropoff_minutes: int = 30,
) -> DataFrame:
    """ceil pickup to 15 and drop-off to 30 minutes, drop the originals."""
    p_ntz = is_ntz(df.schema[pickup_col].dataType)
    d_ntz = is_ntz(df.schema[dropoff_col].dataType)
    out = df.withColumns(
        {
            "rounded_pickup_datetime": ceil_minutes(F.col(pickup_col), pickup_minutes, p_ntz),
            "rounded_dropoff_datetime": ceil_minutes(F.col(dropoff_col), dropoff_minutes, d_ntz),
        }
    )
    return out.drop(*{pickup_col, dropoff_col})


def scoring_input(
    df: DataFrame,
    pickup_col: str = "tpep_pickup_datetime",
    dropoff_col: str = "tpep_dropoff_datetime",
    label_col: str = "fare_amount",
) -> DataFrame:
    """C4: rounded timestamps, raw timestamps and the label removed."""
    return round_trip_times(df, pickup_col, dropoff_col).drop(label_col)
