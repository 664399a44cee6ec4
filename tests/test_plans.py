"""Plan regression tests: the efficiency properties the design relies on."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NO_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")
NO_ROW_PYTHON = ("BatchEvalPython",)  # row-at-a-time Python UDFs


def _plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan):
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


def test_window_features_one_shuffle_no_python(spark):
    for name in ("C3_pickup_features", "C2_dropoff_features", "A1_tumbling_counts", "A2_sliding_stats"):
        plan = _plan(spark, name)
        assert _shuffles(plan) == 1, name
        assert not any(k in plan for k in NO_ROW_PYTHON + ("ArrowEvalPython", "MapInPandas")), name


def test_no_pairwise_joins_in_core_plans(spark):
    for name in ("J6_training_set", "J5_asof_lookup_raw_ts", "C1_customer_features", "C5_W1_scd2_merge",
                 "W4_champion_history", "A17_M1_quality_profile", "IO7_J8_upsert", "P6_J7_rows_for_keys",
                 "A14_roc_auc_ovr", "L4_preprocess_fit_transform"):
        plan = _plan(spark, name)
        assert not any(k in plan for k in NO_PAIRS), name
        assert not any(k in plan for k in NO_ROW_PYTHON), name


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "IO1_P2_scan_entity_since")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "EqualTo(c_nationkey,7)" in plan
    plan = _plan(spark, "P1_filter_by_ts")
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def _shuffles_that_ran(df):
    """Exchanges of the plan that ran, without those that were reused."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return len(re.findall(r"\bExchange (?:hash|range|single|round)", plan))


def test_two_lookups_by_one_key_share_their_shuffles(spark):
    assert _shuffles_that_ran(entry.queries()["J6_training_set"](spark, SF)) <= 8


def test_class_metrics_read_the_log_once(spark):
    from featurewright.operators import metrics as M

    df = spark.range(1000).selectExpr("id % 3 AS a", "id % 4 AS p", "id / 1000.0D AS s")
    for out in (M.per_class_metrics(df, "a", "p"), M.class_distribution(df, "a", "p"), M.classification_metrics(df, "a", "p")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Range (") == 1 and "Join" not in plan and "Union" not in plan
    plan = M.roc_auc_ovr(df, "a", {"0": "s", "1": "s"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 1  # the offsets of the ordered scan, one row per partition
