"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Every document gets a random key from its id.  Rows are range-sorted by
(source, key); running sums of word counts come from in-partition windows plus
one total per (partition, source).  A source's target is whole epochs plus a
remainder: documents that lie before the remainder in key order are taken once
more and the one across it is cut, so each source meets its budget to the word.

Targets: weights 1, 2, 3, repeating over the sources by code point (null
last), shared over all words; a target stops at ``max_epochs`` times its
source's words and the excess is reshared by weight until none is above.

Null text has 0 words; null source is a source; empty sources get target 0;
rows that agree in source, id and words are numbered in the order they are met, so
a cut among them falls in one of them, as the running sums part them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurewright.llm.common import documents, new_value, small_side, staged
from featurewright.operators.scan import row_index

MAX_EPOCHS = 3
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_col: Column, seed: str = "mix") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, weights: int = 3) -> DataFrame:
    """source, source_size, target, budget (whole words) from rows of (source, size).

    One row per source: the rank that gives the weight is a distributed row
    index and the reshare loop sees sums only.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = staged(
        row_index(totals, [F.col("source").asc_nulls_last()], "rank")
        .withColumn("weight", (F.col("rank") % weights + 1).cast("long"))
    )
    cap = F.col("source_size") * max_epochs
    level, at = 0.0, -1
    while True:  # ends: each turn caps one more source
        above = F.lit(level) * F.col("weight") > cap
        s = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(above, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(above.cast("int")).alias("n"),
        ).first()
        if s["total"] is None or not s["weight"] or s["n"] == at:
            break
        at, level = s["n"], (s["total"] - s["capped"]) / s["weight"]
    target = F.least(F.lit(level) * F.col("weight"), cap.cast("double"))
    return ranked.select("source", "source_size", target.alias("target"), F.floor(target).alias("budget"))


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix"
) -> DataFrame:
    """One row per input row: doc_id, source, size, key, source_size, target, before, taken (words, repeats counted)."""
    sizes = staged(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"), random_key(F.col(id_col), seed).alias("key"),
        )
    )
    targets = staged(source_targets(sizes).select(F.col("source").alias("t_source"), "source_size", "target", "budget"))
    order = [F.col("source").asc_nulls_last(), "key", F.col("doc_id").asc_nulls_last(), "size"]
    ranged = staged(
        sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )
    inside = Window.partitionBy("part", "source").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy("part", "source").agg(F.sum("size").alias("sum"))
        .select(F.col("part").alias("c_part"), F.col("source").alias("c_source"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("carry"))
    )
    local = ranged.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = local.join(small_side(staged(carry)), (F.col("part") == F.col("c_part")) & F.col("source").eqNullSafe(F.col("c_source")))
    out = out.join(small_side(targets), F.col("source").eqNullSafe(F.col("t_source")))
    before = F.col("carry") + F.col("local")
    some = F.col("source_size") > 0
    epochs = F.when(some, F.expr("budget div source_size")).otherwise(0)
    rest = F.when(some, F.col("budget") % F.col("source_size")).otherwise(0)
    part = F.least(F.greatest(rest - before, F.lit(0)), F.col("size"))
    return out.select(
        "doc_id", "source", "size", "key", "source_size", "target", before.alias("before"), epochs.alias("epochs"),
        part.alias("part_words"), (F.col("size") * epochs + part).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The mixed rows, with the columns of ``docs``: each document once per epoch, the one at the cut shortened.

    The plan is reduced to one cut per source, so the texts are neither
    shuffled nor joined row by row.
    """
    cols = docs.columns
    plan = mixture(docs, id_col, text_col, source_col, seed)
    # rows before the cut are taken whole, the first row not taken whole is the cut itself
    at = F.struct("key", F.col("doc_id").isNull().alias("n"), "doc_id", "size")
    cuts = staged(
        plan.groupBy("source").agg(
            F.max("epochs").alias("epochs"),
            F.min(F.when(F.col("part_words") < F.col("size"), at)).alias("cut"),
        )
    )
    # what the rows at the cut get together, and how many they are
    equal = plan.withColumnRenamed("source", "p_source").join(
        small_side(cuts.select("source", "cut")), F.col("p_source").eqNullSafe(F.col("source")) & (at == F.col("cut"))
    ).groupBy(F.col("source").alias("e_source")).agg(F.sum("part_words").alias("part"), F.count(F.lit(1)).alias("rows"))
    cuts = staged(
        cuts.join(equal, F.col("source").eqNullSafe(F.col("e_source")), "left")
        .select(F.col("source").alias("__cut_source"), F.struct("epochs", "cut", "part", "rows").alias("__plan"))
    )
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), F.col(source_col).alias("__source"), F.col(text_col).alias("__text"),
        n_words(F.col(text_col)).alias("__size"),
        F.struct(random_key(F.col(id_col), seed).alias("key"), F.col(id_col).isNull().alias("n"),
                 F.col(id_col).alias("doc_id"), n_words(F.col(text_col)).alias("size")).alias("__at"),
    )
    row = row.join(small_side(cuts), F.col("__source").eqNullSafe(F.col("__cut_source")))
    at_cut = F.coalesce(F.col("__at") == F.col("__plan.cut"), F.lit(False))
    number = F.lit(0).cast("long")
    if not cuts.filter("__plan.rows > 1").isEmpty():
        # equal rows at a cut: number them per source, apart from all others
        same = staged(row.filter(at_cut).withColumn("__met", F.monotonically_increasing_id()))
        placed = staged(row_index(same, [F.col("__source").asc_nulls_last(), "__met"], "__place"))
        first = placed.groupBy(F.col("__source").alias("__f_source")).agg(F.min("__place").alias("__first"))
        placed = placed.join(small_side(staged(first)), F.col("__source").eqNullSafe(F.col("__f_source")))
        placed = placed.withColumn("__number", F.col("__place") - F.col("__first")).select(*row.columns, "__number")
        row = row.filter(~at_cut).withColumn("__number", number).unionByName(placed)
        number = F.col("__number")
    whole = F.col("__plan.cut").isNull() | (F.col("__at") < F.col("__plan.cut"))
    left = F.least(F.greatest(F.col("__plan.part") - number * F.col("__size"), F.lit(0)), F.col("__size"))
    extra = F.when(whole, F.col("__size")).when(at_cut, left).otherwise(0)
    # the first n words with what stands between them
    first_words = F.when(extra > 0, F.regexp_extract_all(F.col("__text"), F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)))
    cut_text = F.when(extra < F.col("__size"), F.array_join(F.slice(first_words, 1, extra.cast("int")), "")).otherwise(F.col("__text"))
    texts = F.concat(
        F.array_repeat(F.col("__text"), F.col("__plan.epochs").cast("int")),
        F.when(extra > 0, F.array(cut_text)).otherwise(F.array().cast("array<string>")),
    )
    out = row.withColumn("__new", F.explode(texts))
    changed = ~F.col("__new").eqNullSafe(F.col("__text"))
    return out.select(*[new_value(c, text_col, F.col("__new"), changed, F.col("__row")[c]).alias(c) for c in cols])


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size * 3.0 / weight, source) AS n FROM w),
c AS (SELECT *, coalesce(sum(3 * source_size) OVER p, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS rest,
             sum(source_size) OVER () AS total
      FROM o WINDOW p AS (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (total - capped)::DOUBLE / rest::DOUBLE AS level FROM c
      WHERE (total - capped)::DOUBLE / rest::DOUBLE * weight <= 3 * source_size ORDER BY n LIMIT 1),
t AS (SELECT source, source_size, least(level * weight, (3 * source_size)::DOUBLE) AS target FROM w, l),
b AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (budget // source_size) + least(greatest(budget % source_size - before, 0), size))::BIGINT AS taken
FROM b
"""
