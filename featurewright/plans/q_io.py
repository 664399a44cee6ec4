"""Registered queries: sources and sinks round trips, predicates (IO1-IO4, IO11, IO12, P3-P5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.operators.prep import split
from featurewright.plans.customer import customer_features, valid_sales
from featurewright.plans.monitoring import quality_profile
from featurewright.plans.q_customer import CFG, PLAIN, ORACLE_CTES, _sources, features_sql
from featurewright.plans.q_metrics import PROFILE_SQL
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.session import scratch_path
from featurewright.sources.sinks import load_split, write_split
from featurewright.sources.standins import contacts, prediction_log, sales
from featurewright.sources.tables import read_listing_csv, read_path, read_sql, read_table, scan, write_listing_csv


@query(
    "IO1_P2_scan_entity_since",
    """SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice
       FROM orders o WHERE o.o_orderdate >= TIMESTAMP '1998-01-01'
         AND o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)""",
)
def io1_scan(spark, sf_dir):
    """IO1/P2: entity (country) equality and a lower date bound, both pushed to the parquet scans."""
    c = scan(contacts(spark, sf_dir), columns=["ContactCode", "CountryCode"], entity_col="CountryCode", entity=7)
    o = scan(read_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"],
             ts_col="o_orderdate", since="1998-01-01")
    return o.join(c.select(F.col("ContactCode").alias("o_custkey")), "o_custkey", "left_semi")


# Violation check over the newest profile windows; every part is a bound parameter.
VIOLATION_SQL = """
SELECT CAST(coalesce(count_if(v > :threshold) >= :violations AND max_by(v, mark) > :threshold, false) AS INT)
       AS query_result
FROM (SELECT IDENTIFIER(:metric) AS v, struct(window, model_id) AS mark
      FROM IDENTIFIER(:profile)
      WHERE log_type = 'INPUT' AND column_name = ':table' AND slice_key IS NULL AND model_id <> '*'
      ORDER BY mark DESC LIMIT :windows)
"""


@query(
    "IO3_M2_sql_template",
    f"""
  SELECT CAST(coalesce(count(*) FILTER (WHERE v > 1300) >= 2 AND arg_max(v, mark) > 1300, false) AS INTEGER)
         AS query_result
  FROM (SELECT mean_absolute_error AS v, (window_start, model_id) AS mark FROM ({PROFILE_SQL})
        WHERE log_type = 'INPUT' AND column_name = ':table' AND slice_key IS NULL AND model_id <> '*'
        ORDER BY window_start DESC, model_id DESC LIMIT 5)
""",
)
def io3_sql_template(spark, sf_dir):
    """IO3 + M2: the violation check as a parameterised SQL statement over a view."""
    prof = quality_profile(prediction_log(spark, sf_dir), "timestamp", "model_id", "prediction", "price")
    prof.createOrReplaceTempView("predictions_profile_metrics")
    return read_sql(spark, VIOLATION_SQL, metric="mean_absolute_error", profile="predictions_profile_metrics",
                    threshold=1300, windows=5, violations=2)


@query(
    "IO4_csv_roundtrip",
    """SELECT doc_id, lang, source, text, '  ' || lang || ' ' AS padded,
              CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN source END AS sparse FROM documents""",
)
def io4_csv(spark, sf_dir):
    """IO4: whole documents (multi-line, quoted text, outer blanks, empty cells, nulls) written as CSV and read back."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "text", F.concat(F.lit("  "), "lang", F.lit(" ")).alias("padded"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, F.col("source")).alias("sparse"),
    )
    path = scratch_path(spark, "listing-csv")
    write_listing_csv(docs, path)
    return read_listing_csv(spark, path, schema=docs.schema)


@query("IO2_path_table", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_returnflag = 'R'")
def io2_path(spark, sf_dir):
    """IO2: a path table (a folder partitioned by return flag) scanned by path with partition pruning."""
    path = scratch_path(spark, "path-table")
    read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag") \
        .write.partitionBy("l_returnflag").parquet(path)
    return read_path(spark, path).where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "IO11_IO12_split_tables",
    f"""SELECT ContactCode, {r_sql('AccountBalance')} AS AccountBalance, lifetime_value, 'train' AS split
        FROM ({features_sql()})
        WHERE repurchase_window_passed = 1
          AND (('0x' || substr(md5(CAST(ContactCode AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0) >= 0.3""",
)
def io11_split(spark, sf_dir):
    """IO11 + IO12: one split table partitioned by split, the train side read back by partition pruning."""
    feats = customer_features(*_sources(spark, sf_dir), PLAIN).where(F.col("repurchase_window_passed") == 1)
    root = scratch_path(spark, "split-tables")
    write_split(split(feats.select("ContactCode", "AccountBalance", "lifetime_value"), "ContactCode", 0.3), root)
    return rounded(load_split(spark, root, "train"))


@query(
    "IO11_IO12_both_splits",
    f"""SELECT ContactCode, {r_sql('AccountBalance')} AS AccountBalance, lifetime_value,
               CASE WHEN (('0x' || substr(md5(CAST(ContactCode AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0) >= 0.3
                    THEN 'train' ELSE 'test' END AS split
        FROM ({features_sql()}) WHERE repurchase_window_passed = 1""",
)
def io11_both_splits(spark, sf_dir):
    """IO11 + IO12: as above, with both sides read back, so rows missing on either one show."""
    feats = customer_features(*_sources(spark, sf_dir), PLAIN).where(F.col("repurchase_window_passed") == 1)
    root = scratch_path(spark, "both-splits")
    write_split(split(feats.select("ContactCode", "AccountBalance", "lifetime_value"), "ContactCode", 0.3), root)
    return rounded(load_split(spark, root, "train").unionByName(load_split(spark, root, "test")))


@query(
    "P3_valid_sales",
    ORACLE_CTES + f"""SELECT who AS ContactCode, bought AS InvoiceDate, {r_sql('amount')} AS NetAmountExclVAT,
                             CAST(priority AS INTEGER) AS IsHI FROM line WHERE valid""",
)
def p3_valid_sales(spark, sf_dir):
    """Sold, positive, not returned."""
    s = scan(sales(spark, sf_dir), ts_col="InvoiceDate", since=CFG.since)
    return rounded(s.where(valid_sales(s)).select(
        "ContactCode", "InvoiceDate", F.col("NetAmountExclVAT").cast("double").alias("NetAmountExclVAT"), "IsHI"
    ))


@query(
    "P4_scoring_candidates",
    f"""SELECT ContactCode, first_hi_purchase_date FROM ({features_sql()})
        WHERE first_purchase_made = 1 AND repurchase_window_passed = 0 AND repurchase_flag = 0""",
)
def p4_candidates(spark, sf_dir):
    """Purchased, window still open, not yet repurchased."""
    f = customer_features(*_sources(spark, sf_dir), PLAIN)
    return f.where(
        (F.col("first_purchase_made") == 1) & (F.col("repurchase_window_passed") == 0) & (F.col("repurchase_flag") == 0)
    ).select("ContactCode", "first_hi_purchase_date")


@query(
    "P5_training_rows",
    f"""SELECT ContactCode, repurchase_flag, lifetime_value FROM ({features_sql()})
        WHERE repurchase_window_passed = 1""",
)
def p5_training_rows(spark, sf_dir):
    """P5: rows whose repurchase window has closed."""
    f = customer_features(*_sources(spark, sf_dir), PLAIN)
    return f.where(F.col("repurchase_window_passed") == 1).select("ContactCode", "repurchase_flag", "lifetime_value")
