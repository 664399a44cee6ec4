"""Registered queries: tables whose schema changes from write to write (IO5, IO8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.plans.q_sinks import _table
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources import sinks
from featurewright.sources.evolution import write_evolving
from featurewright.sources.tables import read_table


def _versions(spark, sf_dir):
    """The customers in three batches by balance, each with a schema of its own."""
    c = read_table(spark, sf_dir, "customer")
    first, second = F.coalesce(F.col("c_acctbal") < 0, F.lit(False)), F.coalesce(F.col("c_acctbal").between(0, 5000), F.lit(False))
    segment = F.col("c_mktsegment").alias("segment")
    return (
        c.where(first).select(F.col("c_custkey").cast("int").alias("id"), F.col("c_nationkey").cast("smallint").alias("nation"),
                              F.struct(segment).alias("account")),
        c.where(second).select(F.col("c_custkey").alias("id"), F.struct(F.col("c_acctbal").alias("balance"), segment).alias("account"),
                               F.col("c_name").alias("name")),
        c.where(~first & ~second).select(F.col("c_name").alias("NAME"), F.col("c_custkey").cast("int").alias("id"),
                                         F.col("c_nationkey").cast("int").alias("nation")),
    )


@query(
    "IO5_schema_merge",
    f"""SELECT c_custkey AS id, CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN NULL ELSE CAST(c_nationkey AS INTEGER) END AS nation,
               CASE WHEN c_acctbal <= 5000 THEN c_mktsegment END AS segment,
               CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN {r_sql('c_acctbal')} END AS balance,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name
        FROM customer""",
)
def io5_schema_merge(spark, sf_dir):
    """IO5: three appends with a widened, a missing and a new column, and a struct that grows; the table holds the union."""
    name = _table("evolving")
    for version in _versions(spark, sf_dir):
        write_evolving(spark, name, version)
    return rounded(spark.table(name).select("id", "nation", "account.segment", "account.balance", "name"))


@query(
    "IO5_schema_merge_overwrite",
    f"""SELECT c_custkey AS id, CAST(NULL AS INTEGER) AS nation, c_mktsegment AS segment, {r_sql('c_acctbal')} AS balance, c_name AS name
        FROM customer WHERE c_acctbal BETWEEN 0 AND 5000""",
)
def io5_schema_merge_overwrite(spark, sf_dir):
    """IO5: rows replaced, schema merged: columns that the new rows lack stay, as null."""
    name, (first, second, third) = _table("evolving"), _versions(spark, sf_dir)
    write_evolving(spark, name, third)
    write_evolving(spark, name, first, mode="overwrite")
    write_evolving(spark, name, second, mode="overwrite")
    return rounded(spark.table(name).select("id", "nation", "account.segment", "account.balance", "name"))


@query("IO8_refresh_partitioned", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'")
def io8_refresh_partitioned(spark, sf_dir):
    """IO8 on a partitioned table: partitions that the new rows lack are emptied, in any session."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("o_year"))
    name = _table("refresh")
    sinks.overwrite_table(orders.drop("o_orderdate"), name, ["o_year"])
    sinks.refresh(spark, name, orders.where("o_orderdate >= TIMESTAMP_NTZ '1997-01-01'").drop("o_orderdate"))
    return spark.table(name)
