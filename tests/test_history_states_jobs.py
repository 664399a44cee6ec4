"""Incremental history, mergeable profiles, sparse models and feature jobs by name."""

import datetime as dt
import sys
import types

import pytest
from pyspark.sql import functions as F

from featurewright.operators.history import dense_ids, rekey, scd2_merge
from featurewright.operators.models import train_logistic
from featurewright.operators.prep import PrepConfig, Preprocessor, SparsePreprocessor
from featurewright.operators.sparse_models import feature_index, train_sparse_logistic
from featurewright.plans.feature_job import ContractError, FeatureJob, load_function, run_feature_job
from featurewright.plans.monitoring import merge_states, profile_of_states, profile_state, quality_profile, roll_up
from featurewright.sources import sinks

OLD, NEW = dt.date(2020, 1, 1), "2021-01-01"
HISTORY = "id bigint, key bigint, value double, active_flag string, start_date date, end_date date"


@pytest.mark.parametrize("ids, n", [([], 0), ([0], 1), ([2, 0, 1], 3), ([0, 0, 2], None), ([0, 2, 3], None), ([0, None], None), ([1, 2], None),
                                    ([0, 0, 3, 4, 4, 5, 5], None), ([0, 4, 5, 3, 4, 5, 0], None)])
def test_dense_ids(spark, ids, n):
    assert dense_ids(spark.createDataFrame([(i,) for i in ids], "id bigint")) == n


def _stored(spark, ids=None):
    rows = [(i if ids is None else ids[i], i // 2, float(i), "NY"[i % 2], OLD, None) for i in range(10)]
    return spark.createDataFrame(rows, HISTORY).repartition(3)


@pytest.mark.parametrize("changed_only", [False, True])
@pytest.mark.parametrize("ids", [None, [7, 3, None, 1, 0, 2, 9, 9, 20, 30]])
def test_merge_numbers_as_a_full_renumbering_does(spark, changed_only, ids):
    incoming = spark.createDataFrame([(8, 1.0), (1, 3.0), (2, 99.0), (7, 1.0)], "key bigint, value double")
    how = dict(changed_only=changed_only, compare=["value"]) if changed_only else {}
    got = scd2_merge(_stored(spark, ids), incoming, "key", NEW, **how)
    assert sorted(r["id"] for r in got.collect()) == list(range(got.count()))
    if ids is None:
        full = rekey(got.withColumn("id", F.when(F.col("start_date") == F.lit(OLD), F.col("id"))), "id", tie=["key"])
        assert sorted(map(str, got.collect())) == sorted(map(str, full.select(*got.columns).collect()))
    active = [r["key"] for r in got.where("active_flag = 'Y'").collect()]
    assert len(active) == len(set(active)) if changed_only else active.count(1) == 1


def test_stored_side_is_not_sorted(spark):
    """Dense ids: no range exchange over the stored rows; with a gap there is one."""
    incoming = spark.createDataFrame([(8, 1.0)], "key bigint, value double")
    dense = scd2_merge(_stored(spark), incoming, "key", NEW)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in dense and "Sort" not in dense


def test_history_table_rewrites_touched_partitions_only(spark):
    name = "history_parts"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = [(i, i, float(i), "Y", OLD, None, 2000 + i % 5) for i in range(20)]
    sinks.overwrite_table(spark.createDataFrame(rows, HISTORY + ", year int"), name, ["year"])
    before = {f for f in spark.table(name).inputFiles()}
    incoming = spark.createDataFrame([(3, -1.0, 2004), (50, -2.0, 2004)], "key bigint, value double, year int")
    assert sinks.write_history(spark, name, incoming, "key", NEW)
    after = {f for f in spark.table(name).inputFiles()}
    gone = {f.split("year=")[1][:4] for f in before - after}
    assert gone == {"2003", "2004"}  # where key 3 is closed, and where the new rows go
    got = {r["id"]: r for r in spark.table(name).collect()}
    assert sorted(got) == list(range(22)) and got[3]["active_flag"] == "N" and (got[20]["key"], got[21]["key"]) == (3, 50)
    # closing by flag moves rows between partitions: the whole table is written
    spark.sql("DROP TABLE IF EXISTS history_flag")
    sinks.overwrite_table(spark.createDataFrame([(0, 1, 1.0, "Y", OLD, None)], HISTORY), "history_flag", ["active_flag"])
    assert not sinks.write_history(spark, "history_flag", spark.createDataFrame([(1, 2.0)], "key bigint, value double"), "key", NEW)
    assert sorted((r["key"], r["active_flag"]) for r in spark.table("history_flag").collect()) == [(1, "N"), (1, "Y")]


def _log(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(t + dt.timedelta(hours=h), ["a", "b", None][h % 3], None if h % 11 == 0 else float(h), None if h % 7 == 0 else 100.0 + h * 1.5) for h in range(100)]
    return spark.createDataFrame(rows, "at timestamp, model string, pred double, label double")


@pytest.mark.parametrize("shift", [0.0, 150.0])
def test_states_add_up_to_the_direct_profile(spark, shift):
    log = _log(spark)
    how = ("at", "model", "pred", "label")
    parts = [profile_state(log.where(c), *how, "1 hour", shift) for c in ("pred < 40", "pred >= 40", "pred IS NULL")]
    merged = merge_states(merge_states(parts[0], parts[2]), parts[1])
    for width in ("1 day", "6 hours"):
        got = {(r["window"]["start"], r["model_id"]): r for r in profile_of_states(roll_up(merged, width), width).collect()}
        want = quality_profile(log, *how, width).collect()
        assert len(got) == len(want)
        for r in want:
            for c in r.asDict():
                assert got[r["window"]["start"], r["model_id"]][c] == (pytest.approx(r[c], rel=1e-9, abs=1e-9) if isinstance(r[c], float) else r[c])


def _people(spark, n=600):
    return spark.createDataFrame([(i, float(i % 13), ["x", "y", "z", None][i % 4], i % 5, int(i % 13 > 5) if i % 50 else None) for i in range(n)],
                                 "id int, num double, cat string, code int, y int").repartition(4)


def test_sparse_and_wide_models_agree(spark):
    df = _people(spark)
    cfg = PrepConfig(["num"], ["cat", "code"], 0.0001, keep_cols=("id", "y"))
    sparse = train_sparse_logistic(df, cfg, "y")
    wide = Preprocessor(cfg).fit(df.where("y IS NOT NULL"))
    model = train_logistic(wide.transform(df.where("y IS NOT NULL")), wide.kept, "y")
    want = dict(zip(wide.kept, model.stages[-1].coefficients))
    got = {r["feature"]: r["coefficient"] for r in sparse.coefficients().collect()}
    assert got == pytest.approx(want, abs=1e-6) and len(got) == sparse.index.size()
    unseen = spark.createDataFrame([(1, 3.0, "never seen", 0, None), (2, None, None, None, None)], "id int, num double, cat string, code int, y int")
    assert sparse.score(unseen, ["id"]).count() == 2


def test_ten_thousand_levels(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 10_001).cast("string").alias("level"), (F.col("id") % 10_001 < 5000).cast("int").alias("y"))
    cfg = PrepConfig([], ["level"], None, keep_cols=("id", "y"))
    model = train_sparse_logistic(df, cfg, "y", max_iter=20)
    assert model.index.size() == 10_000
    assert model.score(df, ["id", "y"]).where("prediction = y").count() > 29_900
    assert model.index.vectors(df).first()["features"].size == 10_000


def test_index_without_categories_or_levels(spark):
    df = _people(spark).withColumn("one", F.lit("same"))
    assert feature_index(SparsePreprocessor(PrepConfig(["num"], [], None, keep_cols=("id",))).fit(df)).vectors(df).count() == 600
    only = feature_index(SparsePreprocessor(PrepConfig(["num"], ["one"], None, keep_cols=("id",))).fit(df))
    assert only.size() == 1 and only.categorical == []


# --- feature jobs ---------------------------------------------------------------


@pytest.fixture
def module(monkeypatch):
    m = types.ModuleType("features_of_a_test")
    monkeypatch.setitem(sys.modules, m.__name__, m)

    def good(input_df, timestamp_column, start_date, end_date):
        return input_df.groupBy("k", F.col(timestamp_column)).agg(F.count("*").alias("n"))

    m.compute_features_fn = good
    m.no_key = lambda input_df, timestamp_column, start_date, end_date: good(input_df, timestamp_column, 0, 0).drop("k")
    m.text_time = lambda input_df, timestamp_column, **_: good(input_df, timestamp_column, 0, 0).withColumn(timestamp_column, F.lit("x"))
    m.twice = lambda input_df, timestamp_column, **_: good(input_df, timestamp_column, 0, 0).unionByName(good(input_df, timestamp_column, 0, 0))
    m.later = lambda input_df, timestamp_column, **_: good(input_df, timestamp_column, 0, 0).withColumn(timestamp_column, F.col(timestamp_column) + F.expr("INTERVAL 9 DAYS"))
    m.null_key = lambda input_df, timestamp_column, **_: good(input_df, timestamp_column, 0, 0).withColumn("k", F.lit(None).cast("int"))
    m.other_type = lambda input_df, timestamp_column, **_: good(input_df, timestamp_column, 0, 0).withColumn("n", F.lit("1"))
    m.not_a_frame = lambda **_: 5
    m.wrong_arguments = lambda frame: frame
    m.number = 3
    return m.__name__


@pytest.mark.parametrize("name, says", [("nothing", "has no nothing"), ("number", "not a function"), ("wrong_arguments", "can't be called")])
def test_functions_that_do_not_load(module, name, says):
    with pytest.raises(ContractError, match=says):
        load_function(module, name)
    with pytest.raises(ContractError, match="no module"):
        load_function("no_such_module_anywhere", name)


def test_results_that_break_the_contract_leave_the_table_alone(spark, module):
    t = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, t), (2, t), (1, t)], "k int, at timestamp")
    spark.sql("DROP TABLE IF EXISTS job_out")

    def job(function="compute_features_fn"):
        return FeatureJob(module, "job_out", ["k"], "at", function)

    run_feature_job(spark, job(), df, "2024-01-01", "2024-01-03")
    run_feature_job(spark, job(), df.where("k = 1").unionByName(df.where("k = 1")), "2024-01-01", "2024-01-03")
    want = {1: 4, 2: 1}
    for name, says in [("no_key", "missing"), ("text_time", "not a time"), ("twice", "duplicate key"), ("later", "outside"), ("null_key", "lack a key"),
                       ("other_type", "differs in"), ("not_a_frame", "not a DataFrame")]:
        with pytest.raises(ContractError, match=says):
            run_feature_job(spark, job(name), df, "2024-01-01", "2024-01-03")
        assert {r["k"]: r["n"] for r in spark.table("job_out").collect()} == want
