"""What the driver holds for near-dedup: broadcast sides by their size there, few tasks once texts are left behind."""

from pyspark.sql import functions as F

from featurewright.llm import common, near_dedup


def test_sides_are_measured_as_the_driver_holds_them(spark):
    # 20,000 rows of three numbers: 3 MB as a hash table (160 bytes a row measured), 1 MB as plain words
    side = common.staged(spark.range(20_000).select("id", F.col("id").alias("a"), F.col("id").alias("b")))
    hinted = lambda limit: "broadcast" in common.small_side(side, limit)._jdf.queryExecution().analyzed().toString()
    assert not hinted(2 << 20)
    assert hinted(4 << 20)


def test_rows_without_texts_take_few_tasks(spark, monkeypatch):
    seen, verified, confirmed = [], near_dedup._verified, near_dedup._confirmed

    def count(df):
        seen.append(df.rdd.getNumPartitions())
        return df

    monkeypatch.setattr(near_dedup, "_verified", lambda some, *a: verified(count(some), *a))
    monkeypatch.setattr(near_dedup, "_confirmed", lambda pairs, nodes, *a: count(confirmed(pairs, count(nodes), *a)))
    words = "one two three four five six seven eight nine ten".split()
    docs = [(i, " ".join([*words, "" if i % 2 else "again", *[f"w{i // 2}_{j}" for j in range(40)]])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(40)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(df).collect()}
    assert got == {i: i - i % 2 for i in range(40)}
    assert len(seen) >= 3 and max(seen) <= 8
