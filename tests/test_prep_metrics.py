"""Preprocessing properties, metric known answers, AUC against brute force."""

import random

from pyspark.sql import functions as F

from featurewright.operators.metrics import classification_metrics, per_class_metrics, roc_auc
from featurewright.operators.prep import PrepConfig, Preprocessor, fill_zero, hash_unit, min_max, split


def test_min_max_range_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x double, c double")
    out = min_max(df, ["x", "c"]).collect()
    assert sorted(r["x"] for r in out) == [0.0, 0.5, 1.0]
    assert {r["c"] for r in out} == {0.0}


def test_split_is_stable_partition(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = split(df, "k", 0.3)
    b = split(df.repartition(7), "k", 0.3)
    assert a.exceptAll(b).count() == 0
    n_test = a.where(F.col("split") == "test").count()
    assert 500 < n_test < 700
    assert a.select(F.min(hash_unit(F.col("k"))), F.max(hash_unit(F.col("k")))).first()[1] < 1.0


def test_fitted_state_reused_on_new_data(spark):
    train = spark.createDataFrame([(1, 1.0, "a"), (2, 3.0, "b"), (3, None, "c")], "k int, x double, s string")
    fitted = Preprocessor(PrepConfig(["x"], ["s"], 0.0, keep_cols=["k"])).fit(train)
    assert fitted.levels == {"s": ["b", "c"]}  # first level dropped
    new = spark.createDataFrame([(9, 2.0, "zzz")], "k int, x double, s string")
    row = fitted.transform(new).collect()[0].asDict()
    assert row == {"k": 9, "x": 2.0 / 3.0, "s_b": 0.0, "s_c": 0.0}  # unseen level -> all zero
    again = type(fitted).from_json(fitted.to_json())
    assert again == fitted


def test_fill_zero_strings_and_numbers(spark):
    df = spark.createDataFrame([(None, None)], "a double, b string")
    assert fill_zero(df).collect()[0].asDict() == {"a": 0.0, "b": "0"}


def test_classification_metrics_known(spark):
    rows = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(1, 0)] * 2
    df = spark.createDataFrame(rows, "a int, p int")
    m = classification_metrics(df, "a", "p").collect()[0]
    # class 0: p=3/5 r=3/4; class 1: p=2/3 r=2/4; support 4 and 4
    assert abs(m["accuracy"] - 5 / 8) < 1e-12
    assert abs(m["precision"] - (0.6 + 2 / 3) / 2) < 1e-12
    assert abs(m["recall"] - (0.75 + 0.5) / 2) < 1e-12
    pc = {r["class"]: r for r in per_class_metrics(df, "a", "p").collect()}
    assert abs(pc[0]["recall"] - 0.75) < 1e-12 and abs(pc[1]["precision"] - 2 / 3) < 1e-12


def test_auc_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 30))) for _ in range(500)]
    got = roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").collect()[0]["auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_evaluate_regression_with_custom_metric(spark):
    from featurewright.operators.metrics import evaluate_regression, squared_diff_plus_one_col

    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "p double, y double")
    m = evaluate_regression(df, "p", "y", {"squared_diff_plus_one": squared_diff_plus_one_col}).collect()[0]
    assert m["count"] == 3 and abs(m["mean_squared_error"] - 2 / 3) < 1e-12
    assert m["max_error"] == 1.0 and abs(m["mean_absolute_error"] - 2 / 3) < 1e-12
    assert abs(m["r2_score"] - (1 - (2 / 3) / (2 / 3))) < 1e-12
    assert m["squared_diff_plus_one"] == 0.0 + 1.0 + 4.0


def test_check_thresholds_with_baseline(spark):
    from featurewright.operators.metrics import check_thresholds

    cand = spark.createDataFrame([("mse", 400.0), ("r2", 0.9)], "metric string, value double")
    base = spark.createDataFrame([("mse", 410.0), ("r2", 0.8)], "metric string, value double")
    th = spark.createDataFrame(
        [("mse", 500.0, False, 20.0, None), ("r2", 0.8, True, None, 0.1)],
        "metric string, threshold double, higher_is_better boolean, min_absolute_change double, "
        "min_relative_change double",
    )
    got = {r["metric"]: r["passed"] for r in check_thresholds(cand, th, base).collect()}
    assert got == {"mse": False, "r2": True}  # mse improved by 10 < 20; r2 by 12.5 % >= 10 %
    plain = {r["metric"]: r["passed"] for r in check_thresholds(cand, th).collect()}
    assert plain == {"mse": True, "r2": True}


def test_confusion_and_distribution_known(spark):
    from featurewright.operators.metrics import class_distribution, confusion_matrix

    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "a int, p int")
    cm = {(r["actual"], r["predicted"]): r["n"] for r in confusion_matrix(df, "a", "p").collect()}
    assert cm == {(0, 0): 1, (0, 1): 1, (1, 1): 2, (2, 0): 1}
    dist = {r["class"]: (r["n_predicted"], r["n_actual"]) for r in class_distribution(df, "a", "p").collect()}
    assert dist == {0: (2, 2), 1: (3, 2), 2: (0, 1)}
