"""Registered queries: preprocessing, splits, buckets."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from featurewright.functions.scalar import bucket, bucket_sql
from featurewright.operators.prep import (
    PrepConfig,
    SparsePreprocessor,
    column_ranges_df,
    column_variances_df,
    downsample,
    fill_zero,
    min_max,
    split,
)
from featurewright.plans.customer import appointment_totals, customer_features, in_window_sales, sales_summary
from featurewright.plans.q_customer import CFG, ORACLE_CTES, _pre_and_dates, _sources, features_sql
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources.standins import (
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    VALUE_BUCKETS,
    appointments,
    contacts,
)
from featurewright.sources.tables import read_table, scan

LINE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _hash_sql(expr: str) -> str:
    return f"(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


def _prep_sql(source: str, key: str, numeric, categorical, min_variance: float | None) -> str:
    """Long-form (key, feature, value) preprocessing in SQL, levels and ranges from the data."""
    fill = ", ".join(
        [f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in numeric]
        + [f"COALESCE(CAST({c} AS VARCHAR), '0') AS {c}" for c in categorical]
    )
    levels = " UNION ALL ".join(
        f"SELECT '{c}' AS col, lvl FROM (SELECT DISTINCT {c} AS lvl FROM filled)" for c in categorical
    )
    vals = " UNION ALL ".join(f"SELECT {key}, '{c}' AS col, {c} AS v FROM filled" for c in categorical)
    num_long = " UNION ALL ".join(
        f"SELECT {key}, '{c}' AS feature, {c} AS value FROM filled" for c in numeric
    ) or f"SELECT {key}, '' AS feature, 0.0 AS value FROM filled WHERE false"
    keep = (
        f"AND feature IN (SELECT feature FROM scaled GROUP BY feature HAVING var_pop(value) > {min_variance})"
        if min_variance is not None else ""
    )
    return f"""
    WITH src AS ({source}),
    filled AS (SELECT {key}, {fill} FROM src),
    ranked AS (SELECT col, lvl, row_number() OVER (PARTITION BY col ORDER BY lvl) AS rn FROM ({levels})),
    cat_long AS (
      SELECT c.{key}, r.col || '_' || r.lvl AS feature, CASE WHEN c.v = r.lvl THEN 1.0 ELSE 0.0 END AS value
      FROM ({vals}) c JOIN ranked r ON c.col = r.col WHERE r.rn > 1),
    raw AS ({num_long} UNION ALL SELECT * FROM cat_long),
    scaled AS (
      SELECT {key}, feature,
             (value - min(value) OVER w) /
             CASE WHEN max(value) OVER w - min(value) OVER w = 0 THEN 1
                  ELSE max(value) OVER w - min(value) OVER w END AS value
      FROM raw WINDOW w AS (PARTITION BY feature))
    SELECT {key}, feature, {r_sql('value')} AS value FROM scaled WHERE value <> 0 {keep}
    """


_TRAIN_SQL = f"SELECT * FROM ({features_sql()}) WHERE repurchase_window_passed = 1"


@query(
    "L4_preprocess_fit_transform",
    _prep_sql(_TRAIN_SQL, "ContactCode", NUMERIC_FEATURES, CATEGORICAL_FEATURES, 0.0001),
)
def l4_preprocess(spark, sf_dir):
    """L4 (P5, P15, L1, L2, L3): fit on closed-window customers, transform, entries that are not zero."""
    feats = customer_features(*_sources(spark, sf_dir), replace(CFG, id_col=None))
    train = feats.where(F.col("repurchase_window_passed") == 1)
    cfg = PrepConfig(NUMERIC_FEATURES, CATEGORICAL_FEATURES, 0.0001, keep_cols=("ContactCode",))
    return rounded(SparsePreprocessor(cfg).fit(train).transform(train))


_CONTACTS_SQL = """SELECT c_custkey AS ContactCode, c_mktsegment AS Segment,
                          CAST(c_nationkey AS VARCHAR) AS TerritoryCode FROM customer"""


@query(
    "L1_one_hot",
    _prep_sql(_CONTACTS_SQL, "ContactCode", (), CATEGORICAL_FEATURES, None),
)
def l1_one_hot(spark, sf_dir):
    """L1: one-hot with the first (string-sorted) level dropped, entries that are not zero."""
    c = contacts(spark, sf_dir)
    cfg = PrepConfig((), CATEGORICAL_FEATURES, None, keep_cols=("ContactCode",))
    return SparsePreprocessor(cfg).fit(c).transform(c)


@query(
    "L2_min_max",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        r_sql(f"(CAST({c} AS DOUBLE) - min({c}) OVER ()) / CASE WHEN max({c}) OVER () = min({c}) OVER () "
              f"THEN 1 ELSE max({c}) OVER () - min({c}) OVER () END") + f" AS {c}"
        for c in LINE_COLS
    )
    + " FROM lineitem",
)
def l2_min_max(spark, sf_dir):
    """L2: min-max scaling of the lineitem measures (one aggregate row, then a projection)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_COLS)
    return rounded(min_max(li, LINE_COLS))


@query(
    "A9_column_ranges",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, "
        f"CAST(max({c}) AS DOUBLE) AS max_value FROM lineitem"
        for c in LINE_COLS
    ),
)
def a9_ranges(spark, sf_dir):
    """Per-column min and max in one aggregate."""
    return rounded(column_ranges_df(read_table(spark, sf_dir, "lineitem"), LINE_COLS))


@query(
    "A10_L3_variances",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r_sql(f'var_pop({c})')} AS variance, "
        f"var_pop({c}) > 0.001 AS keep FROM lineitem"
        for c in LINE_COLS
    ),
)
def a10_variances(spark, sf_dir):
    """A10/L3: population variance per column and the keep decision (variance > 0.001)."""
    return rounded(column_variances_df(read_table(spark, sf_dir, "lineitem"), LINE_COLS, 0.001))


@query(
    "L5_L6_split_downsample",
    f"""
    SELECT o_orderkey, o_custkey,
           CASE WHEN {_hash_sql('o_orderkey')} < 0.3 THEN 'test' ELSE 'train' END AS split
    FROM orders
    WHERE {_hash_sql("CAST(o_orderkey AS VARCHAR) || ':sample'")} < 0.25
    """,
)
def l5_l6_split(spark, sf_dir):
    """L5 + L6: keyed md5 train/test split (30 % test) and a 25 % keyed sample outside prod."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return downsample(split(o, "o_orderkey", 0.3), "o_orderkey", 0.25, env="dev")


@query(
    "F14_value_bucket",
    ORACLE_CTES + f"""SELECT who AS ContactCode, {bucket_sql('COALESCE(worth, 0)', VALUE_BUCKETS)} AS value_bucket
                      FROM buyer WHERE worth IS NOT NULL""",
)
def f14_bucket(spark, sf_dir):
    """lifetime value to class 0-3 by inclusive, overlapping ranges; else 4."""
    pre, rd = _pre_and_dates(spark, sf_dir)
    summary = sales_summary(in_window_sales(pre, rd))
    return summary.select(
        "ContactCode", bucket(F.coalesce(F.col("lifetime_value"), F.lit(0)), VALUE_BUCKETS).alias("value_bucket")
    )


@query(
    "P15_fill_zero",
    ORACLE_CTES + f"""
    SELECT c_custkey AS ContactCode, c_mktsegment AS Segment, {r_sql('ifnull(minutes, 0)')} AS pre_repurchase_app_duration,
           ifnull(kept, 0) AS pre_repurchase_app_attended, ifnull(missed, 0) AS pre_repurchase_app_noshow,
           ifnull(CAST(first_priority AS VARCHAR), '0') AS first_hi
    FROM customer LEFT JOIN visit ON visit.who = c_custkey LEFT JOIN buyer ON buyer.who = c_custkey
    """,
)
def p15_fill_zero(spark, sf_dir):
    """Numeric nulls to 0 and string nulls to "0" after outer joins."""
    _, rd = _pre_and_dates(spark, sf_dir)
    a = scan(appointments(spark, sf_dir), ts_col="Date", since=CFG.since)
    totals = appointment_totals(a, rd)
    c = contacts(spark, sf_dir).select("ContactCode", "Segment")
    joined = c.join(totals, "ContactCode", "left").join(
        rd.select("ContactCode", F.date_format("first_hi_purchase_date", "yyyy-MM-dd HH:mm:ss").alias("first_hi")),
        "ContactCode", "left",
    )
    return rounded(fill_zero(joined))
