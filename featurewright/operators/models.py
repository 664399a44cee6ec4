"""Training and scoring with Spark ML.

The reference fitted single-node libraries on pandas frames; here every
trainer is a ``pyspark.ml`` estimator that fits on the cluster, and scoring is
``transform`` - a projection that keeps the key columns, never a positional
re-attach (J9, J10).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurewright.operators.asof import Lookup, training_set
from featurewright.operators.history import stamp


def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """``class_weight='balanced'``: n / (k * n_class), from one grouped count (k rows).

    The counts enter the projection as one scalar subquery (a map of the k
    classes), so the rows are never shuffled by their few labels.  Rows without
    a label are dropped.
    """
    labelled = df.where(F.col(label).isNotNull())
    counts = labelled.groupBy(F.col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__nc"))
    classes = counts.agg(F.struct(
        F.sum("__nc").alias("n"), F.count(F.lit(1)).alias("k"),
        F.map_from_entries(F.collect_list(F.struct("__label", "__nc"))).alias("of_class"),
    ).alias("__classes")).scalar()
    own = F.element_at(classes.getField("of_class"), F.col(label))
    return labelled.withColumn(weight_col, classes.getField("n") / (classes.getField("k") * own))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def train_logistic(df: DataFrame, features: Sequence[str], label: str, balanced: bool = True,
                   max_iter: int = 10000) -> PipelineModel:
    """Class-weighted logistic regression with the reference's L2 penalty.

    A penalty of C = 1 on the summed loss is 1 / (sum of weights) on Spark's mean
    loss; balanced weights sum to the number of rows.
    """
    src = balanced_weights(df, label) if balanced else df.where(F.col(label).isNotNull())
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                            regParam=1.0 / max(src.count(), 1), standardization=False,
                            weightCol="weight" if balanced else None)
    return Pipeline(stages=[_assembler(features), lr]).fit(src)


@dataclass(frozen=True)
class BoostParams:
    max_depth: int = 3
    eta: float = 0.3
    num_class: int = 5
    num_rounds: int = 100


def train_bucket_classifier(df: DataFrame, features: Sequence[str], label: str,
                            params: BoostParams = BoostParams()) -> PipelineModel:
    """Multiclass boosted trees as one-vs-rest binary GBTs (depth 3, step 0.3, 100 rounds).

    The model emits one raw score per class (``rawPrediction``) and the
    arg-max class (``prediction``).
    """
    gbt = GBTClassifier(maxDepth=params.max_depth, stepSize=params.eta, maxIter=params.num_rounds, seed=7)
    # The per-class models are independent jobs: train them concurrently.
    ovr = OneVsRest(classifier=gbt, featuresCol="features", labelCol=label, parallelism=params.num_class)
    src = df.withColumn(label, F.col(label).cast("double"))
    return Pipeline(stages=[_assembler(features), ovr]).fit(src)


def train_fare_regressor(df: DataFrame, features: Sequence[str], label: str, rounds: int = 100,
                         max_depth: int = 5) -> PipelineModel:
    """Boosted regression trees, 100 rounds, depth 5 (32 leaves)."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=max_depth, seed=7)
    return Pipeline(stages=[_assembler(features), gbt]).fit(df)


def train_forest_regressor(df: DataFrame, features: Sequence[str], label: str, trees: int = 100,
                           max_depth: int = 5) -> PipelineModel:
    """Random forest regression, 100 trees, depth 5."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=max_depth,
                               seed=7)
    return Pipeline(stages=[_assembler(features), rf]).fit(df)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str] | None = None,
          raw_scores: bool = False) -> DataFrame:
    """Batch scoring; predictions stay attached to their own rows."""
    out = model.transform(df)
    cols = list(keep) if keep is not None else list(df.columns)
    extra = [F.col("prediction")]
    if raw_scores and "rawPrediction" in out.columns:
        raw = vector_to_array("rawPrediction")
        # a boosted class margin m has probability 1 / (1 + exp(-2 m)); normalised over the classes
        each = F.transform(raw, lambda m: 1 / (1 + F.exp(-2 * m)))
        total = F.aggregate(each, F.lit(0.0), lambda a, p: a + p)
        extra += [raw.alias("raw_scores"), F.transform(each, lambda p: p / total).alias("probabilities")]
    return out.select(*cols, *extra)


def model_udf(predict, return_type: str = "double"):
    """S1 for a plain Python model (anything with ``predict(pandas.DataFrame)``).

    Returns an Arrow-batched pandas UDF over a struct of feature columns - the
    same call shape as the reference's model UDF over ``struct(*features)`` -
    so scoring runs in vectorised batches on the executors, never row by row.
    The model object is shipped once per task with the UDF closure.
    """
    @F.pandas_udf(return_type)
    def _score(features: pd.DataFrame) -> pd.Series:
        out = predict(features)
        return pd.Series(list(out) if not isinstance(out, pd.Series) else out.values)

    return _score


def score_struct(df: DataFrame, predict, features: Sequence[str], out_col: str = "prediction",
                 return_type: str = "double") -> DataFrame:
    """Apply ``model_udf(predict)`` to ``struct(*features)`` and keep every input column."""
    return df.withColumn(out_col, model_udf(predict, return_type)(F.struct(*[F.col(c) for c in features])))


def score_with_lookup(df: DataFrame, lookups: Sequence[Lookup], model, model_version: str,
                      scored_at: str, exclude: Sequence[str] = (), fill: float | None = None,
                      bucket: str | Sequence[str] = "1 day") -> DataFrame:
    """As-of feature lookup, scoring and lineage stamp in one plan.

    ``model`` is a fitted pipeline, or a ``predict(pandas.DataFrame)`` over the
    looked-up features.  Features that no row precedes stay null, as in a
    training set, unless ``fill`` is given.
    """
    feats = training_set(df, lookups, exclude_columns=exclude, bucket=bucket)
    names = [n for lk in lookups for n in (lk.rename.get(f, f) for f in lk.features)]
    if fill is not None:
        feats = feats.fillna(fill, subset=names)
    scored = score(feats, model) if isinstance(model, PipelineModel) else score_struct(feats, model, names)
    return stamp(scored, model_version, scored_at)
