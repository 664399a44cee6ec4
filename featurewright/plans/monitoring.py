"""Quality profile and retraining trigger.

The profile is the hosted monitor's inference-log table, rebuilt as one
grouping-sets aggregate: regression metrics per time window and model, plus an
all-models row (``model_id = '*'``).  The violation check reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurewright.operators.metrics import regression_aggs


def quality_profile(
    log: DataFrame,
    ts: str,
    model_id: str,
    pred: str,
    label: str,
    granularity: str = "1 day",
) -> DataFrame:
    """Metrics per (window, model) and per window over all models.

    Columns: window struct(start, end), granularity, model_id ('*' for all),
    column_name (':table'), slice_key, slice_value (null), log_type ('INPUT'),
    count and the regression metrics.  One Expand (x2) feeds one partial
    aggregation, so a hot model is combined on the map side.
    """
    src = log.select(
        F.window(ts, granularity).alias("window"),
        F.col(model_id).cast("string").alias("model_id"),
        F.col(pred).alias("__pred"),
        F.col(label).alias("__label"),
    )
    agg = src.groupingSets([["window", "model_id"], ["window"]], "window", "model_id").agg(
        F.grouping("model_id").alias("__all"), *regression_aggs("__pred", "__label")
    )
    return agg.select(
        "window",
        F.lit(granularity).alias("granularity"),
        F.when(F.col("__all") == 1, F.lit("*")).otherwise(F.col("model_id")).alias("model_id"),
        F.lit(":table").alias("column_name"),
        F.lit(None).cast("string").alias("slice_key"),
        F.lit(None).cast("string").alias("slice_value"),
        F.lit("INPUT").alias("log_type"),
        "count", "mean_squared_error", "root_mean_squared_error", "mean_absolute_error",
        "r2_score", "max_error",
    )


#: What a profile row is computed from; sums and a maximum, so states of any parts add up.
STATE = ("n", "n_both", "n_label", "sum_sq", "sum_abs", "max_abs", "sum_y", "sum_yy")


def profile_state(log: DataFrame, ts: str, model_id: str, pred: str, label: str, granularity: str = "1 hour", shift: float = 0.0) -> DataFrame:
    """A17 as sufficient statistics per (window start, model): stored once, merged and rolled up without the log.

    ``shift`` is subtracted from labels before they are squared; a value near their mean keeps
    the variance exact where it is small beside the mean.  States that are merged
    must share it.
    """
    err = F.col(pred).cast("double") - F.col(label).cast("double")
    y = F.col(label).cast("double") - F.lit(float(shift))
    return log.groupBy(F.window(ts, granularity)["start"].cast("timestamp").alias("start"), F.col(model_id).cast("string").alias("model_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count(err).alias("n_both"), F.count(y).alias("n_label"), F.sum(err * err).alias("sum_sq"), F.sum(F.abs(err)).alias("sum_abs"),
        F.max(F.abs(err)).alias("max_abs"), F.sum(y).alias("sum_y"), F.sum(y * y).alias("sum_yy"),
    )


def _added() -> list:
    return [(F.max if c == "max_abs" else F.sum)(c).alias(c) for c in STATE]


def merge_states(first: DataFrame, second: DataFrame) -> DataFrame:
    """The state of both logs together, window by window; late data are a state of their own."""
    return first.unionByName(second).groupBy("start", "model_id").agg(*_added())


def roll_up(states: DataFrame, granularity: str) -> DataFrame:
    """States of coarser windows, whose width is a multiple of the finer one."""
    return states.groupBy(F.window("start", granularity)["start"].alias("start"), "model_id").agg(*_added())


def profile_of_states(states: DataFrame, granularity: str) -> DataFrame:
    """The profile table (see ``quality_profile``) of states that have this granularity."""
    agg = states.groupingSets([["start", "model_id"], ["start"]], "start", "model_id").agg(F.grouping("model_id").alias("__all"), *_added())
    mse = F.try_divide("sum_sq", "n_both")
    mean = F.try_divide("sum_y", "n_label")
    variance = F.try_divide("sum_yy", "n_label") - mean * mean
    return agg.withColumn("end", F.col("start") + F.expr(f"INTERVAL {granularity}")).select(
        F.struct("start", "end").alias("window"),
        F.lit(granularity).alias("granularity"),
        F.when(F.col("__all") == 1, F.lit("*")).otherwise(F.col("model_id")).alias("model_id"),
        F.lit(":table").alias("column_name"),
        F.lit(None).cast("string").alias("slice_key"),
        F.lit(None).cast("string").alias("slice_value"),
        F.lit("INPUT").alias("log_type"),
        F.col("n").alias("count"), mse.alias("mean_squared_error"), F.sqrt(mse).alias("root_mean_squared_error"),
        F.try_divide("sum_abs", "n_both").alias("mean_absolute_error"),
        (F.lit(1.0) - F.try_divide(mse, F.nullif(variance, F.lit(0.0)))).alias("r2_score"),
        F.col("max_abs").alias("max_error"),
    )


def refresh_states(spark, table: str, increment: DataFrame) -> None:
    """Merge the state of new, or late, log rows into a stored state table, one row per (start, model)."""
    from featurewright.sources.sinks import overwrite_table, refresh, table_exists

    if not table_exists(spark, table):
        overwrite_table(increment, table)
    else:
        refresh(spark, table, merge_states(spark.table(table), increment).select(*spark.table(table).columns))


def _table_rows(profile: DataFrame) -> DataFrame:
    """Whole-table, per-model, primary-log rows."""
    return profile.where(
        (F.col("column_name") == ":table")
        & F.col("slice_key").isNull()
        & (F.col("model_id") != "*")
        & (F.col("log_type") == "INPUT")
    )


def top_recent(df: DataFrame, n: int, order=("window.start", "model_id")) -> DataFrame:
    """The ``n`` most recent rows (ties broken by model id, descending).

    ``orderBy(desc).limit(n)`` plans as TakeOrderedAndProject: each partition
    keeps its own top n, then n per partition are merged.
    """
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def latest_value(df: DataFrame, value: str, order: str = "window.start") -> DataFrame:
    """The value of the most recent row, as one aggregate (max_by keeps a null value)."""
    return df.agg(F.max_by(F.col(value), F.struct(F.col(order), F.col("model_id"))).alias(f"latest_{value}"))


def metric_violated(
    profile: DataFrame,
    metric: str,
    threshold: float,
    num_evaluation_windows: int = 5,
    num_violation_windows: int = 2,
    per_model: bool = False,
) -> DataFrame:
    """M2: 1 when at least K of the last N rows exceed the threshold and the latest does too.

    Parity (Q11): the last N *rows* across models, ordered by window (then
    model id, to make ties deterministic).  ``per_model=True`` evaluates each
    model's own last N windows instead and returns one row per model.
    A null latest value gives 0.
    """
    rows = _table_rows(profile).select(
        "model_id", F.col("window.start").alias("w"), F.col(metric).alias("m")
    )
    over = F.col("m") > F.lit(threshold)
    if per_model:
        rk = F.row_number().over(Window.partitionBy("model_id").orderBy(F.col("w").desc()))
        recent = rows.withColumn("__rk", rk).where(F.col("__rk") <= num_evaluation_windows)
        agg = recent.groupBy("model_id").agg(
            F.count_if(over).alias("__n_over"), F.max_by("m", "w").alias("__latest")
        )
        keys = ["model_id"]
    else:
        recent = rows.orderBy(F.col("w").desc(), F.col("model_id").desc()).limit(num_evaluation_windows)
        agg = recent.agg(
            F.count_if(over).alias("__n_over"),
            F.max_by("m", F.struct("w", "model_id")).alias("__latest"),
        )
        keys = []
    fired = (F.col("__n_over") >= num_violation_windows) & (F.col("__latest") > F.lit(threshold))
    return agg.select(*keys, F.when(fired, F.lit(1)).otherwise(F.lit(0)).alias("query_result"))


class QualityMonitor:
    """The inference-log monitor's call shape on catalog tables (A17/M1 + M2).

    ``refresh()`` writes ``<table>_profile_metrics`` - one grouping-sets
    aggregate per granularity.  With ``since`` only windows starting at or
    after it are recomputed (the log is pruned by the time filter) and the
    older windows are kept, so a daily refresh reads one day of log, not all
    of it.  ``violated()`` runs the retraining check on the stored profile.
    """

    def __init__(self, spark, table_name: str, model_id_col: str, prediction_col: str, label_col: str,
                 timestamp_col: str, granularities=("1 day",), output_table: str | None = None):
        self.spark = spark
        self.table_name = table_name
        self.cols = (timestamp_col, model_id_col, prediction_col, label_col)
        self.granularities = tuple(granularities)
        self.output_table = output_table or f"{table_name}_profile_metrics"

    def profile(self, since: str | None = None) -> DataFrame:
        from functools import reduce

        from featurewright.operators.windows import filter_by_ts

        ts, model, pred, label = self.cols
        log = filter_by_ts(self.spark.table(self.table_name), ts, since, None)
        parts = [quality_profile(log, ts, model, pred, label, g) for g in self.granularities]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _aligned(self, since: str) -> str:
        """``since`` floored to a window start of the coarsest granularity (no window is split)."""
        import datetime as dt

        from featurewright.operators.asof import interval_micros

        width = max(interval_micros(g) for g in self.granularities)
        t = dt.datetime.fromisoformat(str(since))
        us = int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        start = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us - us % width)
        return start.isoformat(sep=" ")

    def refresh(self, since: str | None = None) -> None:
        from featurewright.session import materialize
        from featurewright.sources.sinks import overwrite_table, table_exists
        from featurewright.sources.tables import ts_literal

        if since is not None:
            since = self._aligned(since)
        fresh = self.profile(since)
        if since is not None and table_exists(self.spark, self.output_table):
            kept = self.spark.table(self.output_table).where(F.col("window.start") < ts_literal(since))
            fresh = kept.unionByName(fresh)
        overwrite_table(materialize(fresh), self.output_table)

    def violated(self, metric: str, threshold: float, num_evaluation_windows: int = 5,
                 num_violation_windows: int = 2, granularity: str | None = None,
                 per_model: bool = False) -> DataFrame:
        prof = self.spark.table(self.output_table)
        g = granularity or self.granularities[0]
        prof = prof.where(F.col("granularity") == g)
        return metric_violated(prof, metric, threshold, num_evaluation_windows, num_violation_windows, per_model)
