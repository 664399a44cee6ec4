"""Registered queries: feature jobs by function name, models on sparse features (§2.12, L4, L7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurewright.operators.prep import PrepConfig, SparsePreprocessor
from featurewright.operators.sparse_models import feature_index, train_sparse_logistic
from featurewright.plans.feature_job import FeatureJob, run_feature_job
from featurewright.plans.q_sinks import _table
from featurewright.plans.q_trips import DROPOFF_SQL, PICKUP_SQL
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources.standins import trips
from featurewright.sources.tables import read_table

_CUT = "2024-01-15 00:00:00"


def _split_windows(sql: str) -> str:
    """The two runs' windows: rows before the cut and from it on count apart; a window that both see is the later run's."""
    early, late = (sql.replace("FROM events", f"FROM (FROM events WHERE ts {op} TIMESTAMP '{_CUT}') AS events") for op in ("<", ">="))
    return f"WITH early AS ({early}), late AS ({late}) FROM late UNION ALL SELECT * FROM early WHERE (zip, ts) NOT IN (SELECT (zip, ts) FROM late)"


def _job(spark, sf_dir, function):
    events, name = trips(spark, sf_dir), _table("feature_job")
    job = FeatureJob("featurewright.plans.event_features", name, ["zip"], "ts", function, ["yyyy_mm"])
    run_feature_job(spark, job, events, None, _CUT)
    run_feature_job(spark, job, events, _CUT, None)
    return rounded(spark.table(name))


@query("X12_feature_job_pickup", _split_windows(PICKUP_SQL))
def x12_pickup(spark, sf_dir):
    """§2.12: a feature function loaded by name, run for two periods, merged into its table."""
    return _job(spark, sf_dir, "compute_features_fn")


@query("X12_feature_job_dropoff", _split_windows(DROPOFF_SQL))
def x12_dropoff(spark, sf_dir):
    """§2.12 with another function of the module."""
    return _job(spark, sf_dir, "compute_dropoff_features")


_CFG = PrepConfig(["l_quantity", "l_extendedprice"], ["l_partkey", "l_linestatus"], 0.0, keep_cols=("l_orderkey", "l_linenumber", "label"))


def _lines(spark, sf_dir):
    """Lines with thousands of parts as a category; the label follows from the part and the quantity."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_CFG.numeric, *_CFG.categorical)
    return li.withColumn("label", ((F.col("l_partkey") % 3 == 0) | (F.col("l_quantity") > 45)).cast("int"))


@query(
    "L4_feature_index",
    """WITH levels AS (SELECT DISTINCT 'l_partkey' AS column_name, CAST(l_partkey AS VARCHAR) AS level FROM lineitem
                       UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem)
       SELECT column_name, level, row_number() OVER (PARTITION BY column_name ORDER BY level) - 2 AS idx FROM levels QUALIFY idx >= 0""",
)
def l4_feature_index(spark, sf_dir):
    """L4: every encoded level's number within its column, without a list of levels on the driver."""
    return feature_index(SparsePreprocessor(_CFG).fit(_lines(spark, sf_dir))).levels


@query("L7_sparse_logistic")
def l7_sparse_logistic(spark, sf_dir):
    """L4 -> L7: logistic regression on sparse one-hot vectors of thousands of levels; all lines scored."""
    lines = _lines(spark, sf_dir)
    return train_sparse_logistic(lines, _CFG, "label", max_iter=30).score(lines)


@query(
    "L7_sparse_logistic_accuracy",
    "SELECT count(*) AS n, " + r_sql("avg(CASE WHEN l_partkey % 3 = 0 OR l_quantity > 45 THEN 1.0 ELSE 0.0 END)") + " AS share, true AS above_nine_tenths FROM lineitem",
)
def l7_sparse_logistic_accuracy(spark, sf_dir):
    """Lines, the label's share, and whether the model is right for more than nine tenths of them."""
    scored = l7_sparse_logistic(spark, sf_dir)
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return rounded(scored.agg(F.count("*").alias("n"), F.avg("label").alias("share"), (right > 0.9).alias("above_nine_tenths")))
