"""Registered queries: evaluation metrics, quality profile, violation check, top-k."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from featurewright.operators.metrics import (
    REGRESSION_METRICS,
    check_thresholds,
    class_distribution,
    classification_metrics,
    compare_metrics,
    confusion_matrix,
    metrics_long,
    per_class_metrics,
    regression_metrics,
    roc_auc,
    roc_auc_ovr,
    squared_diff_plus_one,
)
from featurewright.plans.monitoring import latest_value, metric_violated, profile_of_states, profile_state, quality_profile, refresh_states, roll_up, top_recent
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources.standins import classification_log, prediction_log, trips

PLOG = """(SELECT l_returnflag AS model_id, l_extendedprice * (1 - l_discount) AS prediction,
                  l_extendedprice AS price, l_shipdate AS "timestamp" FROM lineitem)"""


def _reg_sql(src: str, by: str = "") -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""
    SELECT {sel}count(*) AS count,
           {r_sql('avg(e * e)')} AS mean_squared_error,
           {r_sql('sqrt(avg(e * e))')} AS root_mean_squared_error,
           {r_sql('avg(abs(e))')} AS mean_absolute_error,
           {r_sql('1 - avg(e * e) / nullif(var_pop(price), 0)')} AS r2_score,
           {r_sql('max(abs(e))')} AS max_error
    FROM (SELECT *, prediction - price AS e FROM {src}){grp}"""


PROFILE_SQL = f"""
  SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, '1 day' AS granularity,
         CASE WHEN GROUPING(model_id) = 1 THEN '*' ELSE model_id END AS model_id,
         ':table' AS column_name, CAST(NULL AS VARCHAR) AS slice_key, CAST(NULL AS VARCHAR) AS slice_value,
         'INPUT' AS log_type, count(*) AS count,
         {r_sql('avg(e * e)')} AS mean_squared_error,
         {r_sql('sqrt(avg(e * e))')} AS root_mean_squared_error,
         {r_sql('avg(abs(e))')} AS mean_absolute_error,
         {r_sql('1 - avg(e * e) / nullif(var_pop(price), 0)')} AS r2_score,
         {r_sql('max(abs(e))')} AS max_error
  FROM (SELECT model_id, price, prediction - price AS e, time_bucket(INTERVAL 1 DAY, "timestamp") AS w
        FROM {PLOG})
  GROUP BY GROUPING SETS ((w, model_id), (w))
"""


def _profile(spark, sf_dir):
    return quality_profile(prediction_log(spark, sf_dir), "timestamp", "model_id", "prediction", "price", "1 day")


def _flat(profile):
    return profile.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[c for c in profile.columns if c != "window"],
    )


@query("A17_M1_quality_profile", PROFILE_SQL)
def a17_profile(spark, sf_dir):
    """Daily regression metrics per model plus the all-models row (grouping sets)."""
    return rounded(_flat(_profile(spark, sf_dir)))


def _ntz_window(profile):
    """The window as the direct profile of a log without time zone has it."""
    start, end = (F.col(f"window.{c}").cast("timestamp_ntz").alias(c) for c in ("start", "end"))
    return profile.withColumn("window", F.struct(start, end))


@query("A17_profile_rolled_up", PROFILE_SQL)
def a17_rolled_up(spark, sf_dir):
    """Hourly sufficient statistics rolled up to days = the direct daily profile."""
    hourly = profile_state(prediction_log(spark, sf_dir), "timestamp", "model_id", "prediction", "price", "1 hour", shift=35_000.0)
    return rounded(_flat(_ntz_window(profile_of_states(roll_up(hourly, "1 day"), "1 day"))))


@query("A17_profile_late_increment", PROFILE_SQL)
def a17_late_increment(spark, sf_dir):
    """One model's rows arrive after the others and are merged into the stored states = the direct daily profile."""
    log = prediction_log(spark, sf_dir)
    first = log.agg(F.min("model_id")).first()[0]
    table = f"fw_states_{uuid.uuid4().hex}"
    late = F.col("model_id").eqNullSafe(F.lit(first)) | (F.col("price") > 30_000)
    for rows in (log.where(~F.coalesce(late, F.lit(False))), log.where(F.coalesce(late, F.lit(False)))):
        refresh_states(spark, table, profile_state(rows, "timestamp", "model_id", "prediction", "price", "1 hour", shift=35_000.0))
    return rounded(_flat(_ntz_window(profile_of_states(roll_up(spark.table(table), "1 day"), "1 day"))))


_RECENT = f"""
  WITH profile AS ({PROFILE_SQL}),
  recent AS (SELECT root_mean_squared_error AS m, window_start AS w, model_id FROM profile
             WHERE column_name = ':table' AND slice_key IS NULL AND model_id <> '*' AND log_type = 'INPUT'
             ORDER BY window_start DESC, model_id DESC LIMIT 5)
"""


@query(
    "M2_metric_violation_check",
    _RECENT + """
  SELECT CASE WHEN (SELECT count(*) FROM recent WHERE m > 100) >= 2
               AND (SELECT m FROM recent ORDER BY w DESC, model_id DESC LIMIT 1) > 100
              THEN 1 ELSE 0 END AS query_result
""",
)
def m2_violation(spark, sf_dir):
    """M2: RMSE > 100 in >= 2 of the last 5 rows and in the latest one (reference settings)."""
    return metric_violated(_profile(spark, sf_dir), "root_mean_squared_error", 100.0, 5, 2)


@query(
    "M2_metric_violation_per_model",
    f"""
  WITH profile AS ({PROFILE_SQL}),
  ranked AS (SELECT model_id, window_start AS w, mean_absolute_error AS m,
                    row_number() OVER (PARTITION BY model_id ORDER BY window_start DESC) AS rk
             FROM profile WHERE column_name = ':table' AND slice_key IS NULL AND model_id <> '*'
               AND log_type = 'INPUT')
  SELECT model_id,
         CASE WHEN count(*) FILTER (WHERE m > 1300) >= 2 AND arg_max(m, w) > 1300 THEN 1 ELSE 0 END
           AS query_result
  FROM ranked WHERE rk <= 5 GROUP BY model_id
""",
)
def m2_violation_per_model(spark, sf_dir):
    """M2 per model: each model's own last 5 daily windows, MAE threshold 1300."""
    return metric_violated(_profile(spark, sf_dir), "mean_absolute_error", 1300.0, 5, 2, per_model=True)


@query(
    "T1_top_recent",
    f"""
  WITH profile AS ({PROFILE_SQL})
  SELECT window_start, model_id, root_mean_squared_error FROM profile
  WHERE column_name = ':table' AND slice_key IS NULL AND model_id <> '*' AND log_type = 'INPUT'
  ORDER BY window_start DESC, model_id DESC LIMIT 5
""",
)
def t1_top_recent(spark, sf_dir):
    """The five most recent per-model profile rows (top-k is the feature)."""
    prof = _profile(spark, sf_dir).where(F.col("model_id") != "*")
    top = top_recent(prof, 5)
    return rounded(top.select(F.col("window.start").alias("window_start"), "model_id", "root_mean_squared_error"))


@query(
    "T2_latest_value",
    f"""
  WITH profile AS ({PROFILE_SQL})
  SELECT arg_max(root_mean_squared_error, (window_start, model_id)) AS latest_root_mean_squared_error
  FROM profile WHERE model_id <> '*'
""",
)
def t2_latest_value(spark, sf_dir):
    """The latest value as one aggregate instead of a scalar subquery."""
    prof = _profile(spark, sf_dir).where(F.col("model_id") != "*")
    return rounded(latest_value(prof, "root_mean_squared_error"))


@query(
    "T3_head_rows",
    f"""SELECT event_id, ts, user_id, event_type, {r_sql('value')} AS value, props
        FROM events ORDER BY ts, event_id LIMIT 10""",
)
def t3_head_rows(spark, sf_dir):
    """A stable 10-row head (sorted), the reference's sample read."""
    return rounded(trips(spark, sf_dir).orderBy("ts", "event_id").limit(10))


@query("A15_regression_metrics", _reg_sql(PLOG, "model_id"))
def a15_regression(spark, sf_dir):
    """MSE, RMSE, MAE, R^2, max error per model in one aggregate."""
    return rounded(regression_metrics(prediction_log(spark, sf_dir), "prediction", "price", ["model_id"]))


@query(
    "A16_squared_diff_plus_one",
    f"SELECT {r_sql('sum(pow(abs(prediction - price + 1), 2))', 2)} AS squared_diff_plus_one FROM {PLOG}",
)
def a16_custom_metric(spark, sf_dir):
    """sum(|prediction - target + 1|^2)."""
    from featurewright.plans.registry import stable_round

    m = squared_diff_plus_one(prediction_log(spark, sf_dir), "prediction", "price")
    return m.select(stable_round(F.col("squared_diff_plus_one"), 2).alias("squared_diff_plus_one"))


@query(
    "A11_confusion_matrix",
    "SELECT quality AS actual, toxic AS predicted, count(*) AS n FROM labels GROUP BY ALL",
)
def a11_confusion(spark, sf_dir):
    """(actual, predicted) counts."""
    return confusion_matrix(classification_log(spark, sf_dir), "actual", "predicted")


_PER_CLASS = """
  WITH cm AS (SELECT quality AS a, toxic AS p, count(*) AS n FROM labels GROUP BY ALL),
  cls AS (SELECT a AS c FROM cm UNION SELECT p FROM cm),
  pc AS (SELECT c,
            CAST((SELECT coalesce(sum(n), 0) FROM cm WHERE a = c) AS BIGINT) AS support,
            CAST((SELECT coalesce(sum(n), 0) FROM cm WHERE p = c) AS BIGINT) AS n_pred,
            CAST((SELECT coalesce(sum(n), 0) FROM cm WHERE a = c AND p = c) AS BIGINT) AS tp
         FROM cls)
"""


@query(
    "A12_classification_metrics",
    _PER_CLASS + f""",
  m AS (SELECT support, tp, coalesce(tp / nullif(n_pred, 0), 0) AS pr,
               coalesce(tp / nullif(support, 0), 0) AS rc FROM pc),
  m2 AS (SELECT *, coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) AS f FROM m)
  SELECT {r_sql('sum(tp) / sum(support)')} AS accuracy,
         {r_sql('sum(support * pr) / sum(support)')} AS precision,
         {r_sql('sum(support * rc) / sum(support)')} AS recall,
         {r_sql('sum(support * f) / sum(support)')} AS f1_score
  FROM m2
""",
)
def a12_classification(spark, sf_dir):
    """Accuracy and support-weighted precision / recall / F1."""
    return rounded(classification_metrics(classification_log(spark, sf_dir), "actual", "predicted"))


@query(
    "A13_per_class_metrics",
    _PER_CLASS + f"""
  SELECT c AS class, support, {r_sql('tp / nullif(support, 0)')} AS recall,
         {r_sql('tp / nullif(n_pred, 0)')} AS precision FROM pc
""",
)
def a13_per_class(spark, sf_dir):
    """Per-class recall and precision from the confusion matrix."""
    return rounded(per_class_metrics(classification_log(spark, sf_dir), "actual", "predicted"))


@query(
    "A18_class_distribution",
    """SELECT class, CAST(sum(p) AS BIGINT) AS n_predicted, CAST(sum(a) AS BIGINT) AS n_actual
       FROM (SELECT quality AS class, 0 AS p, 1 AS a FROM labels
             UNION ALL SELECT toxic, 1, 0 FROM labels) GROUP BY class""",
)
def a18_distribution(spark, sf_dir):
    """Predicted vs actual class counts (the data behind the reference's histogram)."""
    return class_distribution(classification_log(spark, sf_dir), "actual", "predicted")


@query(
    "A14_roc_auc_binary",
    f"""
  WITH s AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, value AS s FROM events),
  r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM s)
  SELECT {r_sql('(sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))')}
         AS auc FROM r
""",
)
def a14_auc_binary(spark, sf_dir):
    """A14 (binary): AUC of value as a score for purchase events, ties counted half."""
    ev = trips(spark, sf_dir).select(
        (F.col("event_type") == "purchase").cast("int").alias("y"), F.col("value").alias("s")
    )
    return rounded(roc_auc(ev, "y", "s"))


_OVR = {"A": "l_discount", "N": "l_tax", "R": "l_quantity"}


@query(
    "A14_roc_auc_ovr",
    "WITH long AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, CASE WHEN l_returnflag = '{c}' THEN 1 ELSE 0 END AS y, CAST({s} AS DOUBLE) AS s "
        f"FROM lineitem" for c, s in _OVR.items()
    )
    + f"""),
  r AS (SELECT c, y, rank() OVER (PARTITION BY c ORDER BY s)
                     + (count(*) OVER (PARTITION BY c, s) - 1) / 2.0 AS rk FROM long)
  SELECT c AS class,
         {r_sql('(sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))')}
         AS auc
  FROM r GROUP BY c
""",
)
def a14_auc_ovr(spark, sf_dir):
    """A14 (one-vs-rest): one AUC per return-flag class, each scored by its own column."""
    from featurewright.sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem")
    return rounded(roc_auc_ovr(li, "l_returnflag", _OVR))


_THRESHOLDS = [("max_error", 500.0, False), ("mean_squared_error", 500.0, False), ("r2_score", 0.8, True)]


@query(
    "M3_check_thresholds",
    f"""
  WITH m AS (UNPIVOT ({_reg_sql(PLOG)}) ON count, mean_squared_error, root_mean_squared_error,
               mean_absolute_error, r2_score, max_error INTO NAME metric VALUE value),
  t AS (SELECT * FROM (VALUES {", ".join(f"('{m}', {v}, {str(h).lower()})" for m, v, h in _THRESHOLDS)})
        AS t(metric, threshold, higher_is_better))
  SELECT t.metric, CAST(m.value AS DOUBLE) AS value, CAST(t.threshold AS DOUBLE) AS threshold,
         t.higher_is_better,
         COALESCE(CASE WHEN t.higher_is_better THEN m.value >= t.threshold ELSE m.value <= t.threshold END,
                  false) AS passed
  FROM t LEFT JOIN m ON t.metric = m.metric
""",
)
def m3_thresholds(spark, sf_dir):
    """M3: validation gates (max_error <= 500, MSE <= 500, R^2 >= 0.8) on the regression log."""
    wide = rounded(regression_metrics(prediction_log(spark, sf_dir), "prediction", "price"))
    long = metrics_long(wide, REGRESSION_METRICS)
    th = spark.createDataFrame(_THRESHOLDS, "metric string, threshold double, higher_is_better boolean")
    return check_thresholds(long, th)


@query(
    "M4_compare_metrics",
    f"""
  WITH c AS (UNPIVOT ({_reg_sql(PLOG)}) ON count, mean_squared_error, root_mean_squared_error,
               mean_absolute_error, r2_score, max_error INTO NAME metric VALUE value),
  b AS (UNPIVOT ({_reg_sql('(SELECT l_extendedprice * (1 - l_discount) * (1 + l_tax) AS prediction, '
                           'l_extendedprice AS price FROM lineitem)')})
        ON count, mean_squared_error, root_mean_squared_error, mean_absolute_error, r2_score, max_error
        INTO NAME metric VALUE value)
  SELECT c.metric, CAST(c.value AS DOUBLE) AS candidate, CAST(b.value AS DOUBLE) AS baseline
  FROM c LEFT JOIN b ON c.metric = b.metric
""",
)
def m4_compare(spark, sf_dir):
    """M4: candidate vs baseline model metrics side by side."""
    log = prediction_log(spark, sf_dir)
    cand = metrics_long(rounded(regression_metrics(log, "prediction", "price")), REGRESSION_METRICS)
    from featurewright.sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("prediction"),
        F.col("l_extendedprice").alias("price"),
    )
    base = metrics_long(rounded(regression_metrics(li, "prediction", "price")), REGRESSION_METRICS)
    return compare_metrics(cand, base)
