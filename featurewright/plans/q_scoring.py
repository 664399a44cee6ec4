"""Registered queries: scoring with a fixed linear model, class weights."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from featurewright.operators.models import balanced_weights, score_struct, score_with_lookup
from featurewright.plans.q_training import TRAINING_SQL
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.plans.training import trip_lookups
from featurewright.plans.trips import dropoff_features, pickup_features, round_trip_times
from featurewright.session import materialize
from featurewright.sources.standins import trips
from featurewright.sources.tables import read_table


def linear_model(x: pd.DataFrame) -> pd.Series:
    """A fixed model over the looked-up trip features, in place of a loaded one."""
    return (2.0 + 0.5 * x["mean_fare_window_1h_pickup_zip"].astype("float64")
            + 0.25 * x["count_trips_window_1h_pickup_zip"] - 0.125 * x["count_trips_window_30m_dropoff_zip"]
            + 1.5 * x["dropoff_is_weekend"])


LINEAR_SQL = f"""
SELECT event_id, user_id, {r_sql("""2.0 + 0.5 * ifnull(CAST(mean_fare_window_1h_pickup_zip AS DOUBLE), 0)
         + 0.25 * ifnull(count_trips_window_1h_pickup_zip, 0) - 0.125 * ifnull(count_trips_window_30m_dropoff_zip, 0)
         + 1.5 * ifnull(dropoff_is_weekend, 0)""")} AS prediction,
       '1' AS model_version, TIMESTAMP '2024-02-01 00:00:00' AS inference_timestamp
FROM ({TRAINING_SQL})
"""


@query("S2_lookup_linear_score", LINEAR_SQL)
def s2_lookup_linear(spark, sf_dir):
    """S2 + J9 + J10: every event looked up, scored and stamped in one plan, its keys kept beside the score."""
    ev = trips(spark, sf_dir)
    lookups = trip_lookups(
        materialize(rounded(pickup_features(ev, "ts", zip_col="user_id", fare_col="value"))),
        materialize(dropoff_features(ev, "ts", zip_col="user_id")), "user_id", "user_id",
    )
    out = score_with_lookup(round_trip_times(ev, "ts", "ts"), lookups, linear_model, "1", "2024-02-01 00:00:00",
                            exclude=["rounded_pickup_datetime", "rounded_dropoff_datetime"], fill=0.0)
    return rounded(out.select("event_id", "user_id", "prediction", "model_version", "inference_timestamp"))


@query(
    "S1_struct_linear_score",
    f"""SELECT l_orderkey, l_linenumber, {r_sql('0.25 * l_quantity + 0.001 * l_extendedprice - 4 * l_discount')}
               AS prediction FROM lineitem""",
)
def s1_struct_linear(spark, sf_dir):
    """A Python model over a struct of features in Arrow batches; predictions stay on their own rows."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    out = score_struct(li, lambda x: 0.25 * x.l_quantity + 0.001 * x.l_extendedprice - 4 * x.l_discount,
                       ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(out.select("l_orderkey", "l_linenumber", "prediction"))


@query(
    "L7_balanced_weights",
    f"""SELECT o_orderkey, o_orderstatus,
               {r_sql('n / (k * count(*) OVER (PARTITION BY o_orderstatus))')} AS weight
        FROM orders, (SELECT count(o_orderstatus) AS n, count(DISTINCT o_orderstatus) AS k FROM orders)
        WHERE o_orderstatus IS NOT NULL""",
)
def l7_balanced_weights(spark, sf_dir):
    """Weight n / (k * n_class) per row, without a shuffle of the rows."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return rounded(balanced_weights(o, "o_orderstatus"))
