"""Exact splits and samples against sorting, and tables whose schema changes."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurewright.operators import selection as S
from featurewright.sources import evolution as E
from featurewright.sources import sinks


def _hash(text, seed):
    return int(hashlib.md5(f"{text}:{seed}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("seed", [0, 5])
def test_split_is_exact_and_by_key(spark, seed):
    rows = [(k, i) for k in range(997) for i in range(1 + k % 3)] + [(None, 0), (None, 1)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(5)
    got = S.exact_split(df, "k", 0.3, seed).collect()
    assert len(got) == len(rows)
    sides = {r["k"]: r["split"] for r in got}
    assert all(sides[r["k"]] == r["split"] for r in got)
    order = sorted([*range(997), None], key=lambda k: (_hash("\0" if k is None else k, seed), str(k)))
    assert {k for k, s in sides.items() if s == "test"} == set(order[:math.ceil(0.3 * 998)])


def test_ties_are_resolved_by_key_and_sizes_at_the_ends(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    for hash_of in (lambda t, s: F.lit(12345).cast("bigint"), lambda t, s: F.when(t < "3", 1 << 59).otherwise(7).cast("bigint")):
        for share in (0.0, 0.001, 0.5, 0.62, 1.0):
            got = {r["k"] for r in S.exact_split(df, "k", share, hash_of=hash_of).where("split = 'test'").collect()}
            texts = [str(i) for i in range(500)]
            value = {t: 12345 for t in texts} if "12345" in str(hash_of(F.lit("x"), 0)) else {t: 1 << 59 if t < "3" else 7 for t in texts}
            assert got == set(sorted(texts, key=lambda t: (value[t], t))[:math.ceil(share * 500)])


def test_sample_size_environment_and_empty(spark):
    df = spark.range(101).select(F.col("id"), (F.col("id") % 10).alias("g"))
    assert S.exact_sample(df, "id", 0.25).count() == 25
    assert S.exact_sample(df, "id", 0.25, env="prod").count() == 101
    assert S.exact_sample(df, ["id", "g"], 0.5, seed=3).count() == round(50.5)
    assert S.exact_sample(df.where("id < 0"), "id").count() == 0
    assert S.exact_split(df.where("id < 0"), "id").columns == ["id", "g", "split"]
    pairs = spark.createDataFrame([("a", "b,c"), ("a,b", "c"), (None, "-"), ("-", None)], "x string, y string")
    assert pairs.select(S.key_text(["x", "y"])).distinct().count() == 4


def test_selection_sorts_nothing(spark):
    df = spark.range(1000)
    plan = S.exact_split(df, "id", 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan


def _type(ddl):
    return T._parse_datatype_string(ddl)


@pytest.mark.parametrize("old, new, both", [
    ("int", "bigint", "bigint"), ("bigint", "smallint", "bigint"), ("float", "double", "double"), ("int", "float", "double"), ("smallint", "float", "float"),
    ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "bigint", "decimal(21,2)"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int>", "struct<A:bigint,b:string>", "struct<a:bigint,b:string>"), ("void", "string", "string"),
    ("array<struct<a:int>>", "array<struct<b:int>>", "array<struct<a:int,b:int>>"),
])
def test_merged_types(old, new, both):
    assert E.merged_type(_type(old), _type(new), "c").simpleString() == both


@pytest.mark.parametrize("old, new", [("int", "string"), ("bigint", "double"), ("date", "timestamp"), ("decimal(38,0)", "decimal(38,10)"),
                                      ("struct<a:int>", "int"), ("struct<a:int>", "struct<a:string>"), ("boolean", "int")])
def test_types_without_a_common_one_raise(old, new):
    with pytest.raises(TypeError, match="no common type"):
        E.merged_type(_type(old), _type(new), "c")


def test_nested_columns_and_partitions_evolve(spark):
    name = "evolve_nested"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    E.write_evolving(spark, name, spark.sql("SELECT 1 AS id, array(struct(1 AS a)) AS xs, map('k', 1) AS m, 'p' AS part"), partition_by=("part",))
    E.write_evolving(spark, name, spark.sql("SELECT 2L AS id, array(struct(2.5D AS b, 3 AS a)) AS xs, map('k', 7L) AS m, 'q' AS part"))
    E.write_evolving(spark, name, spark.sql("SELECT 'q' AS part, 3 AS id, true AS fresh"))
    assert sinks.table_partitions(spark, name) == ["part"]
    rows = {r["id"]: r for r in spark.table(name).collect()}
    assert rows[1]["xs"][0].asDict() == {"a": 1, "b": None} and rows[2]["xs"][0].asDict() == {"a": 3, "b": 2.5}
    assert rows[2]["m"] == {"k": 7} and rows[3]["xs"] is None and rows[3]["fresh"] and rows[1]["fresh"] is None
    assert dict(spark.table(name).dtypes)["id"] == "bigint"
    with pytest.raises(TypeError):
        E.write_evolving(spark, name, spark.sql("SELECT 'x' AS id, 'q' AS part"))
    assert spark.table(name).count() == 3
    E.write_evolving(spark, name, spark.sql("SELECT 9 AS id, 'q' AS part"), mode="overwrite")
    assert [r.asDict() for r in spark.table(name).collect()] == [{"id": 9, "xs": None, "m": None, "fresh": None, "part": "q"}]


def test_new_columns_do_not_rewrite_files(spark):
    name = "evolve_add"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    E.write_evolving(spark, name, spark.sql("SELECT 1 AS id"))
    before = set(spark.table(name).inputFiles())
    E.write_evolving(spark, name, spark.sql("SELECT 2 AS id, 'x' AS more"))
    assert before < set(spark.table(name).inputFiles())
    assert sorted((r["id"], r["more"]) for r in spark.table(name).collect()) == [(1, None), (2, "x")]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_refresh_truncates_whatever_the_session_says(spark, mode):
    name = f"refresh_{mode}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.overwrite_table(spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "a int, p int"), name, ["p"])
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        sinks.refresh(spark, name, spark.table(name).where("p = 2").selectExpr("a + 10", "p"))
        assert [tuple(r) for r in spark.table(name).collect()] == [(12, 2)]
        sinks.rewrite(spark, name, spark.table(name).selectExpr("a", "p + 1"))
        assert [tuple(r) for r in spark.table(name).collect()] == [(12, 3)]
        assert spark.conf.get(key) == mode
    finally:
        spark.conf.set(key, before)
