"""Registered queries: small verbs on inputs that reach their edge cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.functions.scalar import as_int, squash_blanks
from featurewright.functions.time import as_date, as_ts, window_end
from featurewright.operators.history import drop_features, pack_features, scd2_merge
from featurewright.operators.scan import surrogate_id
from featurewright.plans.customer import drop_all_null_columns
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources.tables import read_table


@query("P12_drop_all_null", "SELECT c_custkey, CASE WHEN c_custkey = 1 THEN c_name END AS rare FROM customer")
def p12_drop_all_null(spark, sf_dir):
    """The column without any value goes, the one with a single value stays."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") == 1, F.col("c_name")).alias("rare"),
        F.lit(None).cast("string").alias("fax"), F.when(F.col("c_custkey") < 0, F.lit(1)).alias("unused"),
    )
    return drop_all_null_columns(c, keep=["c_custkey"])


@query("P9_P14_pack_features", f"SELECT p_partkey, p_size, {r_sql('p_retailprice')} AS p_retailprice FROM part")
def p14_pack_features(spark, sf_dir):
    """P9 + P14: unused features dropped, the rest packed into one struct (read back by field here)."""
    part = drop_features(read_table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type", "not_there"])
    return rounded(pack_features(part, ["p_size", "p_retailprice"]).select("p_partkey", "features.*"))


@query(
    "F5_F7_F9_F11_F15_helpers",
    """SELECT o_orderkey, time_bucket(INTERVAL 6 HOUR, o_orderdate) + INTERVAL 6 HOUR AS window_end,
              CAST(o_orderdate AS DATE) AS day,
              CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS parsed,
              replace(o_orderpriority, ' ', '_') AS priority,
              CAST(o_orderstatus = 'F' AS INTEGER) AS finished
       FROM orders""",
)
def time_and_scalar_helpers(spark, sf_dir):
    """F5 window end, F7 date, F9 text to timestamp (dirty text gives null), F11 blanks, F15 boolean to int."""
    text = F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise("n/a")
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        window_end(F.window("o_orderdate", "6 hours")).cast("timestamp_ntz").alias("window_end"),
        as_date("o_orderdate").alias("day"),
        as_ts(text).cast("timestamp_ntz").alias("parsed"),
        squash_blanks("o_orderpriority").alias("priority"),
        as_int(F.col("o_orderstatus") == "F").alias("finished"),
    )


@query(
    "C5_scd2_changed_only",
    f"""
  WITH stored AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS id, c_custkey AS key, c_acctbal AS value,
                         DATE '1999-01-01' AS start_date FROM customer),
  changed AS (SELECT key, value + 1 AS value FROM stored WHERE key % 3 <> 0),
  fresh AS (SELECT -key - 1 AS key, value FROM stored WHERE key % 50 = 0),
  versions AS (
    SELECT id, key, value, start_date, key % 3 <> 0 AS closed FROM stored
    UNION ALL SELECT NULL, key, value, DATE '2000-01-01', false FROM (FROM changed UNION ALL FROM fresh))
  SELECT row_number() OVER (ORDER BY id NULLS LAST, key) - 1 AS id, key, {r_sql('value')} AS value,
         CASE WHEN closed THEN 'N' ELSE 'Y' END AS active_flag, start_date,
         CASE WHEN closed THEN DATE '2000-01-01' END AS end_date
  FROM versions
""",
)
def c5_changed_only(spark, sf_dir):
    """C5 with ``changed_only``: a third of the keys is unchanged, some are new; one active row per key remains."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"))
    stored = surrogate_id(c.select(
        "key", "value", F.lit("Y").alias("active_flag"), F.to_date(F.lit("1999-01-01")).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
    ), ["key"]).select("id", "key", "value", "active_flag", "start_date", "end_date")
    incoming = c.withColumn("value", F.when(F.col("key") % 3 == 0, F.col("value")).otherwise(F.col("value") + 1))
    incoming = incoming.unionByName(c.where(F.col("key") % 50 == 0).withColumn("key", -F.col("key") - 1))
    return rounded(scd2_merge(stored, incoming, "key", "2000-01-01", changed_only=True, compare=["value"]))
