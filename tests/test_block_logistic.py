"""The logistic fit in blocks takes the steps of Spark ML's, with a bounded driver."""

import pytest
from pyspark.sql import functions as F

from featurewright.operators import block_logistic, sparse_models
from featurewright.operators.prep import PrepConfig


def _rows(spark):
    # a level with a third of the rows, null cells, levels of one row, a constant column
    rows = []
    for i in range(600):
        part = 7 if i % 3 == 0 else None if i % 41 == 0 else 100 + (i * i) % 90
        rows.append((i, float((i * 37) % 101) if i % 29 else None, 1.0, part, ["x", "y", "z", None][i % 4], int((i * i) % 7 < 3 or (part or 0) % 5 == 0)))
    return spark.createDataFrame(rows, "id int, num double, same double, part int, side string, y int")


def test_blocks_take_the_steps_of_spark_ml(spark, monkeypatch):
    df, cfg = _rows(spark), PrepConfig(["num", "same"], ["part", "side"], None, keep_cols=("id", "y"))
    want = sparse_models.train_sparse_logistic(df, cfg, "y", max_iter=30)
    assert isinstance(want, sparse_models.SparseLogistic)
    monkeypatch.setattr(sparse_models, "DRIVER_FEATURES", 10)
    monkeypatch.setattr(block_logistic, "BLOCK_ROWS", 50)
    got = sparse_models.train_sparse_logistic(df, cfg, "y", max_iter=30)
    assert isinstance(got, sparse_models.BlockLogistic)  # no vector of the feature space on the driver
    a, b = ({r["id"]: r for r in m.score(df).collect()} for m in (want, got))
    assert a.keys() == b.keys() and len(b) == 600
    for i in a:
        assert b[i]["probability"] == pytest.approx(a[i]["probability"], rel=1e-5, abs=1e-7) and b[i]["prediction"] == a[i]["prediction"] and b[i]["y"] == a[i]["y"]
    a, b = ({r["feature"]: r["coefficient"] for r in m.coefficients().collect()} for m in (want, got))
    assert a.keys() == b.keys()
    assert all(b[f] == pytest.approx(a[f], rel=1e-4, abs=1e-5) for f in a)


def test_one_class_is_left_to_spark_ml(spark, monkeypatch):
    monkeypatch.setattr(sparse_models, "DRIVER_FEATURES", 10)
    df, cfg = _rows(spark).withColumn("y", F.lit(1)), PrepConfig(["num"], ["part"], None, keep_cols=("id", "y"))
    model = sparse_models.train_sparse_logistic(df, cfg, "y")
    assert {r["prediction"] for r in model.score(df).select("prediction").distinct().collect()} == {1.0}
