"""Evaluation metrics as aggregates.

The reference computed these in pandas/sklearn after ``toPandas``.  Here each
metric is a Spark aggregate: one pass over the predictions, partial
aggregation on the map side, and a result of a few rows.  Divisions are
guarded (ANSI mode raises on division by zero).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurewright.operators.scan import prefix_sums


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def confusion_matrix(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """One row per (actual, predicted) pair with its count."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class_counts(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Per class: support (actual count), predicted count, true positives."""
    return _by_class(df, actual, pred).agg(
        F.sum("n_actual").alias("support"), F.sum("n_predicted").alias("n_pred"), F.sum("tp").alias("tp")
    )


def _by_class(df: DataFrame, actual: str, pred: str):
    """The confusion matrix, read once, each cell under its actual and under its predicted class."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(zero)
    cells = F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("n_actual"), zero.alias("n_predicted"), hit.alias("tp")),
        F.struct(F.col("predicted").alias("class"), zero.alias("n_actual"), F.col("n").alias("n_predicted"), zero.alias("tp")),
    )).alias("c")
    return confusion_matrix(df, actual, pred).select(cells).select("c.*").groupBy("class")


def per_class_metrics(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """recall = tp / support and precision = tp / predicted (null when undefined)."""
    c = per_class_counts(df, actual, pred)
    return c.select(
        "class", "support",
        _div(F.col("tp"), F.nullif(F.col("support"), F.lit(0))).alias("recall"),
        _div(F.col("tp"), F.nullif(F.col("n_pred"), F.lit(0))).alias("precision"),
    )


def classification_metrics(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (zero division -> 0)."""
    c = per_class_counts(df, actual, pred)
    prec = F.coalesce(_div(F.col("tp"), F.nullif(F.col("n_pred"), F.lit(0))), F.lit(0.0))
    rec = F.coalesce(_div(F.col("tp"), F.nullif(F.col("support"), F.lit(0))), F.lit(0.0))
    f1 = F.coalesce(_div(2 * prec * rec, F.nullif(prec + rec, F.lit(0.0))), F.lit(0.0))
    m = c.select("support", "tp", prec.alias("p"), rec.alias("r"), f1.alias("f"))
    total = F.sum("support")
    return m.agg(
        _div(F.sum("tp"), total).alias("accuracy"),
        _div(F.sum(F.col("support") * F.col("p")), total).alias("precision"),
        _div(F.sum(F.col("support") * F.col("r")), total).alias("recall"),
        _div(F.sum(F.col("support") * F.col("f")), total).alias("f1_score"),
    )


def class_distribution(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Per class, how often it was predicted and how often it was the actual value."""
    return _by_class(df, actual, pred).agg(F.sum("n_predicted").alias("n_predicted"), F.sum("n_actual").alias("n_actual"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """A14 (binary): area under the ROC curve, ties counted half (Mann-Whitney U).

    Rows are first reduced to one per distinct score (partial aggregation);
    the count of negatives below each score is an ordered prefix sum over
    range partitions, so no single task sees all scores.
    """
    return roc_auc_ovr(df.select(F.lit("1").alias("__c"), F.col(label).alias("__y"), F.col(score).alias("__s")),
                       None, None, _prepared=True).select("auc")


def roc_auc_ovr(
    df: DataFrame,
    actual: str | None,
    scores: Mapping[str, str] | None,
    _prepared: bool = False,
) -> DataFrame:
    """A14 (one-vs-rest): per-class AUC of ``scores[class]`` against ``actual == class``.

    Returns one row per class (``class``, ``auc``); the macro average is
    ``avg(auc)`` over that frame.
    """
    if _prepared:
        long = df
    else:
        assert actual is not None and scores is not None
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(str(c)).alias("__c"),
                     (F.col(actual).cast("string") == F.lit(str(c))).cast("int").alias("__y"),
                     F.col(s).cast("double").alias("__s"))
            for c, s in scores.items()
        ])).alias("x")).select("x.*")
    g = long.groupBy("__c", "__s").agg(
        F.sum(F.col("__y")).cast("double").alias("pos"),
        F.sum(1 - F.col("__y")).cast("double").alias("neg"),
    )
    ps = prefix_sums(g, ["__c", "__s"], ["neg"])
    # A prefix over all (class, score); what lies before the class is its smallest prefix, taken off at the end.
    sums = ps.groupBy(F.col("__c").alias("class")).agg(
        F.sum(F.col("pos") * (F.col("before_neg") + 0.5 * F.col("neg"))).alias("u"), F.min("before_neg").alias("start"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
    )
    return sums.select("class", _div(F.col("u") - F.col("start") * F.col("p"), F.col("p") * F.col("n")).alias("auc"))


REGRESSION_METRICS = (
    "count", "mean_squared_error", "root_mean_squared_error", "mean_absolute_error", "r2_score", "max_error",
)


def regression_aggs(pred: str, target: str) -> list[Column]:
    err = F.col(pred).cast("double") - F.col(target).cast("double")
    mse = F.avg(err * err)
    return [
        F.count(F.lit(1)).alias("count"),
        mse.alias("mean_squared_error"),
        F.sqrt(mse).alias("root_mean_squared_error"),
        F.avg(F.abs(err)).alias("mean_absolute_error"),
        (F.lit(1.0) - _div(mse, F.nullif(F.var_pop(F.col(target).cast("double")), F.lit(0.0)))).alias("r2_score"),
        F.max(F.abs(err)).alias("max_error"),
    ]


def regression_metrics(df: DataFrame, pred: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAE, R^2 and max error in one aggregate (optionally per group)."""
    aggs = regression_aggs(pred, target)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def squared_diff_plus_one_col(pred: Column, target: Column) -> Column:
    """A16 as a pluggable aggregate: sum(|pred - target + 1|^2)."""
    d = F.abs(pred.cast("double") - target.cast("double") + F.lit(1.0))
    return F.sum(d * d)


def squared_diff_plus_one(df: DataFrame, pred: str, target: str) -> DataFrame:
    """The custom metric sum(|pred - target + 1|^2)."""
    return df.agg(squared_diff_plus_one_col(F.col(pred), F.col(target)).alias("squared_diff_plus_one"))


def evaluate_regression(
    df: DataFrame,
    pred: str,
    target: str,
    custom: Mapping[str, object] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """A15 + A16 with user-pluggable metrics, all in one aggregate pass.

    ``custom`` maps a metric name to a callable ``(pred_col, target_col) ->
    aggregate Column`` (e.g. ``squared_diff_plus_one_col``), the Spark form of
    a custom evaluation metric.
    """
    aggs = regression_aggs(pred, target)
    for name, fn in (custom or {}).items():
        aggs.append(fn(F.col(pred), F.col(target)).alias(name))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def metrics_long(wide: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Wide metric row(s) to (metric, value) rows."""
    return wide.select(*keys, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        list(keys), list(names), "metric", "value"
    )


def check_thresholds(metrics: DataFrame, thresholds: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """M3: (metric, value) joined to (metric, threshold, higher_is_better[, min_absolute_change,
    min_relative_change]) -> pass flag.

    ``higher_is_better`` means value >= threshold passes, else value <= threshold.
    With a ``baseline`` (metric, value) frame, optional columns
    ``min_absolute_change`` / ``min_relative_change`` also require the candidate
    to improve on the baseline by at least that amount / fraction (in the
    metric's better direction).  A metric without a value fails.
    """
    j = thresholds.join(metrics, "metric", "left")
    ok = F.when(F.col("higher_is_better"), F.col("value") >= F.col("threshold")).otherwise(
        F.col("value") <= F.col("threshold")
    )
    extra = [c for c in ("min_absolute_change", "min_relative_change") if c in thresholds.columns]
    if baseline is not None and extra:
        j = j.join(baseline.select("metric", F.col("value").alias("baseline_value")), "metric", "left")
        gain = F.when(F.col("higher_is_better"), F.col("value") - F.col("baseline_value")).otherwise(
            F.col("baseline_value") - F.col("value")
        )
        if "min_absolute_change" in extra:
            ok = ok & (F.col("min_absolute_change").isNull() | (gain >= F.col("min_absolute_change")))
        if "min_relative_change" in extra:
            rel = _div(gain, F.nullif(F.abs(F.col("baseline_value")), F.lit(0.0)))
            ok = ok & (F.col("min_relative_change").isNull() | (rel >= F.col("min_relative_change")))
    return j.select("metric", "value", "threshold", "higher_is_better",
                    F.coalesce(ok, F.lit(False)).alias("passed"))


def compare_metrics(candidate: DataFrame, baseline: DataFrame) -> DataFrame:
    """M4: candidate metrics with the baseline value beside them (null when absent, the reference's N/A)."""
    b = baseline.select("metric", F.col("value").alias("baseline"))
    return candidate.select("metric", F.col("value").alias("candidate")).join(b, "metric", "left")
