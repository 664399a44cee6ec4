"""Reference roles played by the shared test tables.

The reference reads catalog tables that do not ship with it (trips, sales,
appointments, contacts, prediction logs, model runs).  Each function below
derives that role from the test tables with plain projections and joins, so
every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.functions.scalar import BucketRange
from featurewright.sources.tables import read_table

# Fixed parameters of the stand-in pipeline.  The repurchase window
# is shortened from the reference's 8 years so both classes of every flag occur
# in test data spanning 1995-2001.
AS_OF = "2000-01-01"
REPURCHASE_WINDOW_YEARS = 2
SALES_SINCE = "1995-01-01"
# Lifetime-value classes for the stand-in money scale (inclusive both sides,
# overlapping edges, first match wins, anything else is class 4).
VALUE_BUCKETS = (
    BucketRange(0, 1.0, 250000.0),
    BucketRange(1, 250000.0, 500000.0),
    BucketRange(2, 500000.0, 1000000.0),
    BucketRange(3, 1000000.0, 100000000.0),
)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips: ``user_id`` is the zip, ``ts`` both pickup and drop-off, ``value`` the fare."""
    return read_table(spark, sf_dir, "events")


# The skew scenario: every finished order ('F', about a third of all orders)
# is booked to this one customer.
HOT_CUSTOMER = 1


def _customer(hot: bool):
    key = F.col("o_custkey")
    return F.when(F.col("o_orderstatus") == "F", F.lit(HOT_CUSTOMER).cast("bigint")).otherwise(key) if hot else key


def sales(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Sales lines: one row per lineitem, keyed by the ordering customer.

    ``hot=True`` books every finished order to one customer, so a single key
    holds about a third of all rows (the skew scenario).
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag"
    )
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        _customer(hot).alias("ContactCode"),
        F.col("o_orderdate").alias("InvoiceDate"),
        # Money as an exact decimal: price and discount have two places each.
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("NetAmountExclVAT"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("SerialNo"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("IsHI"),
        (F.col("o_orderstatus") != "P").cast("int").alias("IsSold"),
        F.when(F.col("l_returnflag") == "R", F.lit("R")).alias("ReturnReasonCode"),
    )


def appointments(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Appointments: one row per lineitem ship date of the ordering customer."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_quantity", "l_linestatus"
    )
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        _customer(hot).alias("ContactCode"),
        F.col("l_shipdate").alias("Date"),
        F.col("l_quantity").alias("Duration"),
        (F.col("l_linestatus") == "F").alias("Attended"),
        (F.col("l_linestatus") == "O").alias("NoShow"),
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts: the customer table with the reference's column roles."""
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ContactCode"),
        F.col("c_nationkey").alias("CountryCode"),
        F.col("c_acctbal").alias("AccountBalance"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("c_nationkey").cast("string").alias("TerritoryCode"),
    )


CONTACT_COLUMNS = ("ContactCode", "CountryCode", "AccountBalance", "Segment", "TerritoryCode")
NUMERIC_FEATURES = (
    "AccountBalance",
    "pre_repurchase_app_duration",
    "pre_repurchase_app_attended",
    "pre_repurchase_app_noshow",
)
CATEGORICAL_FEATURES = ("Segment", "TerritoryCode")


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression log: label = extended price, prediction = discounted price."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prediction"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("timestamp"),
    )


def classification_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary classification log: actual = quality, predicted = toxic."""
    return read_table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("actual"), F.col("toxic").alias("predicted")
    )


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model runs: one per event; model = user bucket, order = ts, metric = value."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("model_"), (F.col("user_id") % 20).cast("string")).alias("model_name"),
        F.col("event_id").cast("string").alias("version"),
        F.col("ts").alias("created"),
        F.col("value").alias("metric"),
        F.col("props"),
        F.col("user_id"),
    )
