"""Registered queries: catalog sinks written from the shared tables and read back (IO5-IO10)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from featurewright.operators.scan import surrogate_id
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources import sinks
from featurewright.sources.tables import read_table, ts_literal


def _table(name: str) -> str:
    return f"fw_{name}_{uuid.uuid4().hex}"


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("o_year")
    )


_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders"
_OUT_SQL = f"SELECT o_orderkey, o_custkey, {r_sql('o_totalprice')} AS o_totalprice, o_year"


def _late_updates(spark, sf_dir):
    """Orders from 1997 on: new prices, every tenth one moved to the year before, every seventh also as a new key."""
    late = read_table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= ts_literal("1997-01-01")).select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        (F.year("o_orderdate") - F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(0)).alias("o_year"),
    )
    return late.unionByName(late.where(F.col("o_orderkey") % 7 == 0).withColumn("o_orderkey", -F.col("o_orderkey") - 1))


_UPDATES_SQL = """
  late AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice,
                  CAST(year(o_orderdate) - CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS o_year
           FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
  updates AS (FROM late UNION ALL
              SELECT -o_orderkey - 1, o_custkey, o_totalprice, o_year FROM late WHERE o_orderkey % 7 = 0)"""


@query(
    "IO5_overwrite_then_merge",
    f"""WITH {_UPDATES_SQL}, target AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM ({_ORDERS_SQL}))
        {_OUT_SQL} FROM (FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
                         UNION ALL FROM updates)""",
)
def io5_overwrite(spark, sf_dir):
    """IO5: contents overwritten, the table's keys stay, so the merge that follows still finds them."""
    name, orders = _table("overwrite"), _orders(spark, sf_dir)
    sinks.create_feature_table(spark, name, orders, ["o_orderkey"])
    sinks.overwrite_table(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), name)
    sinks.write_upsert(spark, name, _late_updates(spark, sf_dir))
    return rounded(spark.table(name))


@query("IO6_create_feature_table", f"{_OUT_SQL} FROM ({_ORDERS_SQL})")
def io6_create(spark, sf_dir):
    """IO6: created once with its key checked; a second call leaves the table as it is."""
    name, orders = _table("create"), _orders(spark, sf_dir)
    sinks.create_feature_table(spark, name, orders, ["o_orderkey"], partition_by=["o_year"])
    sinks.create_feature_table(spark, name, orders.withColumn("o_totalprice", F.lit(0.0)), ["o_orderkey"])
    return rounded(spark.table(name))


@query(
    "IO7_table_upsert",
    f"""WITH {_UPDATES_SQL}, target AS ({_ORDERS_SQL})
        {_OUT_SQL} FROM (FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
                         UNION ALL FROM updates)""",
)
def io7_table_upsert(spark, sf_dir):
    """IO7: upsert into a table partitioned by year, with keys that move to another partition and new keys."""
    name = _table("upsert")
    sinks.create_feature_table(spark, name, _orders(spark, sf_dir), ["o_orderkey"], partition_by=["o_year"])
    sinks.write_upsert(spark, name, _late_updates(spark, sf_dir))
    return rounded(spark.table(name))


@query("IO8_refresh", f"{_OUT_SQL} FROM ({_ORDERS_SQL}) WHERE o_year >= 1997")
def io8_refresh(spark, sf_dir):
    """IO8: truncate and load, the new rows derived from the table that is truncated."""
    name = _table("refresh")
    sinks.overwrite_table(_orders(spark, sf_dir), name)
    sinks.refresh(spark, name, spark.table(name).where("o_year >= 1997"))
    return rounded(spark.table(name))


@query(
    "IO9_rewrite",
    f"""SELECT o_orderkey, o_custkey, {r_sql('o_totalprice * 1.5')} AS o_totalprice, o_year FROM ({_ORDERS_SQL})""",
)
def io9_rewrite(spark, sf_dir):
    """IO9: insert-overwrite of a partitioned table with rows derived from it."""
    name = _table("rewrite")
    sinks.overwrite_table(_orders(spark, sf_dir), name, ["o_year"])
    sinks.rewrite(spark, name, spark.table(name).withColumn("o_totalprice", F.col("o_totalprice") * 1.5))
    return rounded(spark.table(name))


@query(
    "IO10_create_with_id",
    f"""SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS id, o_orderkey, o_custkey,
               {r_sql('o_totalprice')} AS o_totalprice, o_year FROM ({_ORDERS_SQL})""",
)
def io10_create_with_id(spark, sf_dir):
    """IO10: a table with a leading surrogate id from the key order."""
    name = _table("with_id")
    sinks.create_with_id(spark, name, _orders(spark, sf_dir), ["o_orderkey"])
    return rounded(spark.table(name))


_HISTORY_SQL = f"""
  WITH stored AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS id, o_orderkey AS key, o_totalprice AS value, o_year AS start_year FROM ({_ORDERS_SQL})),
  incoming AS (SELECT o_orderkey AS key, o_totalprice + 1 AS value FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
               UNION ALL SELECT -o_orderkey - 1, 5.0 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
  total AS (SELECT count(*) AS n FROM stored)
  SELECT s.id, s.key, {r_sql('s.value')} AS value, s.start_year, CASE WHEN i.key IS NULL THEN 'Y' ELSE 'N' END AS active_flag,
         CASE WHEN i.key IS NOT NULL THEN DATE '2000-01-01' END AS end_date
  FROM stored s LEFT JOIN incoming i USING (key)
  UNION ALL
  SELECT n + row_number() OVER (ORDER BY key) - 1, key, {r_sql('value')}, 2000, 'Y', NULL FROM incoming, total"""


@query("C5_history_table_merge", _HISTORY_SQL)
def c5_history_table(spark, sf_dir):
    """C5 on a table partitioned by start year: touched partitions alone are rewritten, new rows numbered from the high-water mark."""
    orders = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"), F.col("o_year").alias("start_year"))
    name = _table("history")
    stored = surrogate_id(orders, ["key"]).select("id", "key", "value", F.lit("Y").alias("active_flag"), F.lit(None).cast("date").alias("end_date"),
                                                  F.make_date("start_year", F.lit(1), F.lit(1)).alias("start_date"), "start_year")
    sinks.overwrite_table(stored, name, ["start_year"])
    late = read_table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= ts_literal("1997-01-01"))
    incoming = late.select(F.col("o_orderkey").alias("key"), (F.col("o_totalprice") + 1).alias("value")).unionByName(
        late.where(F.col("o_orderdate") >= ts_literal("1998-01-01")).select((-F.col("o_orderkey") - 1).alias("key"), F.lit(5.0).alias("value")))
    if not sinks.write_history(spark, name, incoming.withColumn("start_year", F.lit(2000)), "key", "2000-01-01"):
        raise AssertionError("the whole table was rewritten")
    return rounded(spark.table(name).drop("start_date"))
