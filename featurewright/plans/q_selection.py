"""Registered queries: exact keyed splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.operators.selection import exact_sample, exact_split
from featurewright.plans.registry import query
from featurewright.sources.tables import read_table


def _place(key: str, seed: str) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || ':' || {seed}), 1, 15))::BIGINT, CAST({key} AS VARCHAR)"


@query(
    "L5_exact_split",
    f"""SELECT seed, o_orderkey,
               CASE WHEN row_number() OVER (PARTITION BY seed ORDER BY {_place('o_orderkey', 'seed')})
                         <= ceil(CAST(0.3 AS DOUBLE) * count(*) OVER (PARTITION BY seed)) THEN 'test' ELSE 'train' END AS split
        FROM orders, (VALUES (1), (2)) AS seeds(seed)""",
)
def l5_exact_split(spark, sf_dir):
    """Exactly ceil(0.3 n) orders on the test side, for two seeds."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    one, two = (exact_split(orders, "o_orderkey", 0.3, seed).select(F.lit(seed).alias("seed"), "o_orderkey", "split") for seed in (1, 2))
    return one.unionByName(two)


@query(
    "L6_exact_sample",
    f"""WITH keys AS (SELECT DISTINCT l_orderkey FROM lineitem),
             placed AS (SELECT l_orderkey, row_number() OVER (ORDER BY {_place('l_orderkey', "'7'")}) AS place, count(*) OVER () AS n FROM keys)
        SELECT l_orderkey, l_linenumber FROM lineitem JOIN placed USING (l_orderkey)
        WHERE place <= round_even(CAST(0.25 AS DOUBLE) * n, 0)""",
)
def l6_exact_sample(spark, sf_dir):
    """All lines of exactly a quarter of the orders; a key's rows stay together."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return exact_sample(lines, "l_orderkey", 0.25, seed=7)
