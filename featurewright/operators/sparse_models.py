"""Models on sparse features for any number of category levels.

Levels stay a table: ``SparsePreprocessor`` says which are encoded, ``FeatureIndex``
numbers them within their column, in level order, by range partitions (no task and
no driver sees them all).  A row's level becomes its number by a join that
AQE splits where a level is frequent, and the one-hot vectors are built from numbers,
with the vector size known from the index, without a further scan; no schema or plan names
the levels.  Up to ``DRIVER_FEATURES`` features Spark ML fits the model, whose solver keeps some
twenty vectors of the feature space on the driver; beyond, ``block_logistic`` takes the same steps with the
vectors in blocks, and the coefficients are a column of the level table.

A level that is not encoded (the column's first, one of too little variance, one
not seen at fit time) is an all-zero vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurewright.operators import block_logistic
from featurewright.operators.models import balanced_weights
from featurewright.operators.prep import PrepConfig, SparseFit, SparsePreprocessor, _name, fill_zero, min_max_column
from featurewright.operators.scan import prefix_sums, row_index
from featurewright.session import materialize, scratch_path


#: Features up to which the solver's vectors (8 bytes each, some twenty of them) are left to the driver.
DRIVER_FEATURES = 200_000


def _finite(value: Column) -> Column:
    """A vector's entry: null and NaN end the job, as in Spark ML's assembler."""
    return F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit("a feature is null or NaN")).cast("double")).otherwise(value)


@dataclass
class FeatureIndex:
    """Position of every feature: the numeric columns first, then each categorical column's levels."""

    fit: SparseFit
    levels: DataFrame  # column_name, level, idx: from 0 within the column
    sizes: dict[str, int]  # encoded levels per categorical column

    @property
    def numeric(self) -> list[str]:
        return list(self.fit.ranges)

    @property
    def categorical(self) -> list[str]:
        return [c for c in self.fit.cfg.categorical if self.sizes.get(c)]

    def size(self) -> int:
        return len(self.numeric) + sum(self.sizes.values())

    def cells(self, df: DataFrame, levels: DataFrame, carry: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
        """The keep columns and ``more`` of ``df``, its numeric features ``__n0..``, and what ``levels`` (column_name, level, ..)
        says of each categorical column's level: column ``x`` of ``carry`` as ``__x0..``, null for a level that it does not name."""
        cfg = self.fit.cfg
        rows = fill_zero(df, [*cfg.numeric, *cfg.categorical])
        values = [_finite(min_max_column(c, *self.fit.ranges[c])).alias(f"__n{i}") for i, c in enumerate(self.numeric)]
        names = [_name(c).cast("string").alias(f"__c{j}") for j, c in enumerate(self.categorical)]
        rows = rows.select(*[_name(k) for k in [*cfg.keep_cols, *more]], *values, *names)
        for j, c in enumerate(self.categorical):
            own = levels.where(F.col("column_name") == c).select(F.col("level").alias(f"__l{j}"), *[F.col(x).alias(f"__{x}{j}") for x in carry])
            rows = rows.join(own, F.col(f"__c{j}") == F.col(f"__l{j}"), "left").drop(f"__l{j}", f"__c{j}")
        return rows

    def vectors(self, df: DataFrame, out: str = "features") -> DataFrame:
        """The keep columns and one sparse vector per row of ``df``, computed once into the shared checkpoint folder."""
        rows = self.cells(df, self.levels, ["idx"])
        keep = [_name(k) for k in self.fit.cfg.keep_cols]
        entries = [(F.lit(i), F.col(f"__n{i}")) for i in range(len(self.numeric))]
        at = len(entries)
        for j, c in enumerate(self.categorical):
            entries.append(((F.col(f"__idx{j}") + at).cast("int"), F.lit(1.0)))
            at += self.sizes[c]
        found = F.filter(F.array(*[F.struct(i.alias("i"), v.alias("v")) for i, v in entries]), lambda e: e["i"].isNotNull() & (e["v"] != 0))
        cells = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(at).alias("size"),
                         F.transform(found, lambda e: e["i"]).alias("indices"), F.transform(found, lambda e: e["v"]).alias("values"))
        staged = rows.select(*keep, cells.alias(out))
        path = scratch_path(df.sparkSession, "sparse-vectors")
        staged.write.parquet(path)
        # The parts of a sparse vector, read as one.  Spark ML's encoder and assembler would write the name of every
        # level into the schema, which each plan on the driver then carries along.
        return df.sparkSession.read.schema(T.StructType([*staged.schema.fields[:-1], T.StructField(out, VectorUDT())])).parquet(path)

    def positions(self) -> DataFrame:
        """feature, position in the vector: a table as long as the vector."""
        spark = self.levels.sparkSession
        start, at = [], len(self.numeric)
        for c in self.categorical:
            start += [F.lit(c), F.lit(at)]
            at += self.sizes[c]
        parts = spark.createDataFrame([(c, i) for i, c in enumerate(self.numeric)], "feature string, position bigint")
        if start:
            own = F.element_at(F.create_map(*start), F.col("column_name"))
            parts = parts.unionByName(self.levels.select(F.concat("column_name", F.lit("_"), "level").alias("feature"), (own + F.col("idx")).alias("position")))
        return parts


def feature_index(fit: SparseFit) -> FeatureIndex:
    """Number the encoded levels; as many counts come to the driver as there are categorical columns."""
    levels = materialize(fit.levels)
    sizes = {r["column_name"]: r["count"] for r in levels.groupBy("column_name").count().collect()}
    numbered = row_index(levels, ["column_name", "level"], "place")
    before, total = [], 0
    for c in sorted(sizes):
        before += [F.lit(c), F.lit(total)]
        total += sizes[c]
    own = F.element_at(F.create_map(*before), F.col("column_name")) if before else F.lit(0)
    return FeatureIndex(fit, materialize(numbered.select("column_name", "level", (F.col("place") - own).cast("bigint").alias("idx"))), sizes)


@dataclass
class SparseLogistic:
    index: FeatureIndex
    model: LogisticRegressionModel

    def score(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Keep columns with ``prediction`` and ``probability`` (of class 1 where there are two classes)."""
        from pyspark.ml.functions import vector_to_array

        out = self.model.transform(self.index.vectors(df))
        p = vector_to_array("probability")
        cols = list(keep) if keep is not None else list(self.index.fit.cfg.keep_cols)
        return out.select(*cols, "prediction", (p[1] if self.model.numClasses == 2 else p).alias("probability"))

    def coefficients(self) -> DataFrame:
        """feature, coefficient (binary model): the model's vector, dealt out by position."""
        spark = self.index.levels.sparkSession
        values = [(i, float(v)) for i, v in enumerate(self.model.coefficients)]
        return self.index.positions().join(spark.createDataFrame(values, "position bigint, coefficient double"), "position").select("feature", "coefficient")


@dataclass
class BlockLogistic:
    """A binary model whose coefficients are a column of the level table."""

    index: FeatureIndex
    intercept: float
    numeric: list[float]
    levels: DataFrame  # column_name, level, coefficient

    def score(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Keep columns with ``prediction`` and ``probability`` of class 1."""
        rows = self.index.cells(df, self.levels, ["coefficient"])
        margin = F.lit(self.intercept)
        for i, v in enumerate(self.numeric):
            margin = margin + F.col(f"__n{i}") * F.lit(v)
        for j in range(len(self.index.categorical)):
            margin = margin + F.coalesce(F.col(f"__coefficient{j}"), F.lit(0.0))
        cols = list(keep) if keep is not None else list(self.index.fit.cfg.keep_cols)
        return rows.withColumn("__m", margin).select(
            *[_name(c) for c in cols], (F.col("__m") > 0).cast("double").alias("prediction"), (1 / (1 + F.exp(-F.col("__m")))).alias("probability"))

    def coefficients(self) -> DataFrame:
        """feature, coefficient."""
        spark = self.levels.sparkSession
        numeric = spark.createDataFrame(list(zip(self.index.numeric, self.numeric)), "feature string, coefficient double")
        return numeric.unionByName(self.levels.select(F.concat("column_name", F.lit("_"), "level").alias("feature"), "coefficient"))


def _train_in_blocks(index: FeatureIndex, rows: DataFrame, label: str, balanced: bool, max_iter: int) -> BlockLogistic:
    """The fit of ``block_logistic``: the largest column's levels in blocks of about equal rows, all else shared."""
    spark, numeric, columns = rows.sparkSession, len(index.numeric), index.categorical
    main = max(columns, key=lambda c: index.sizes[c])
    at, start = numeric, {}
    for c in columns:
        if c != main:
            start[c], at = at, at + index.sizes[c]
    rows = balanced_weights(rows, label).withColumnRenamed("weight", "__weight") if balanced else rows.withColumn("__weight", F.lit(1.0))
    n = rows.count()
    blocks = max(spark.sparkContext.defaultParallelism, -(-n // block_logistic.BLOCK_ROWS))
    held = fill_zero(rows, [main]).groupBy(_name(main).cast("string").alias("h_level")).agg(F.count(F.lit(1)).alias("held"))
    own = index.levels.where(F.col("column_name") == main).join(held, F.col("level") == F.col("h_level"))
    # a level of more rows than a block's share is spread over all blocks: fewer levels than blocks
    hot = F.col("held") > n / blocks
    own = prefix_sums(own.select("level", "idx", "held", F.when(hot, 0).otherwise(F.col("held")).alias("take")), ["idx"], ["take"])
    own = materialize(own.withColumn("block", F.least(F.floor(F.col("before_take") / (n / blocks)), F.lit(blocks - 1)).cast("int")).withColumn("hot", hot))
    first = own.groupBy("block").agg(F.min("idx").alias("first")).withColumnRenamed("block", "f_block")
    frequent = sorted(r["idx"] for r in own.where("hot").select("idx").collect())
    number = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(frequent) for x in (f, at + i)]), F.col("idx")) if frequent else F.lit(None)
    own = materialize(own.join(first, F.col("block") == F.col("f_block")).select(
        F.lit(main).alias("column_name"), "level", "idx", "block", (F.col("idx") - F.col("first")).cast("int").alias("place"), F.when(F.col("hot"), number).cast("int").alias("shared")))
    others = index.levels.where(F.col("column_name") != main).select(
        "column_name", "level", "idx", F.lit(None).cast("int").alias("block"), F.lit(None).cast("int").alias("place"),
        (F.element_at(F.create_map(*[F.lit(x) for p in start.items() for x in p]), F.col("column_name")) + F.col("idx") if start else F.lit(None)).cast("int").alias("shared"))
    levels = own.unionByName(others)
    total, j = at + len(frequent), columns.index(main)
    cells = index.cells(rows, levels, ["block", "place", "shared"], ["__weight"])
    inside = F.col(f"__shared{j}").isNull() & F.col(f"__block{j}").isNotNull()
    anywhere = F.pmod(F.xxhash64(*[F.col(c) for c in cells.columns]), F.lit(blocks)).cast("int")
    cells = cells.select(
        F.when(inside, F.col(f"__block{j}")).otherwise(anywhere).alias("block"), F.when(inside, F.col(f"__place{j}")).otherwise(-1).alias("main"),
        *[F.col(f"__n{i}").alias(f"n{i}") for i in range(numeric)], *[F.coalesce(f"__shared{i}", F.lit(-1)).alias(f"c{i}") for i in range(len(columns))],
        _name(label).cast("double").alias("label"), F.col("__weight").cast("double").alias("weight"))
    shared, intercept, parts = block_logistic.fit(block_logistic.pack(cells, numeric, len(columns), blocks), total, numeric, max_iter)

    def unpacked(batches):
        for batch in batches:
            for block, blob in zip(batch["block"], batch["coefs"]):
                coefs = np.frombuffer(blob) if blob else np.zeros(0)
                yield pd.DataFrame({"b_block": np.full(len(coefs), block), "b_place": np.arange(len(coefs)), "of_block": coefs})

    of_block = parts.mapInPandas(unpacked, "b_block int, b_place int, of_block double")
    of_shared = spark.createDataFrame([(i, float(v)) for i, v in enumerate(shared)], "s_shared int, of_shared double")
    found = levels.join(of_block, (F.col("block") == F.col("b_block")) & (F.col("place") == F.col("b_place")) & F.col("shared").isNull(), "left")
    found = found.join(of_shared, F.col("shared") == F.col("s_shared"), "left")
    return BlockLogistic(index, intercept, [float(v) for v in shared[:numeric]],
                         materialize(found.select("column_name", "level", F.coalesce("of_shared", "of_block", F.lit(0.0)).alias("coefficient"))))


def train_sparse_logistic(df: DataFrame, cfg: PrepConfig, label: str, balanced: bool = True, max_iter: int = 10000) -> SparseLogistic | BlockLogistic:
    """L4 -> L7: preprocessing fitted, features numbered, class-weighted logistic regression with the reference's penalty.

    ``label`` must be one of the keep columns; rows without a label are left out.
    """
    if label not in cfg.keep_cols:
        raise ValueError(f"{label} must be one of the keep columns")
    rows = df.where(_name(label).isNotNull())
    index = feature_index(SparsePreprocessor(cfg).fit(rows))
    if index.size() > DRIVER_FEATURES and index.categorical:
        classes = {float(r[0]) for r in rows.select(_name(label)).distinct().limit(3).collect()}
        if classes == {0.0, 1.0}:
            return _train_in_blocks(index, rows, label, balanced, max_iter)
    vectors = index.vectors(rows)
    # A step of the fit adds up one array as long as the vector per task: no more tasks than cores.
    vectors = vectors.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, 1))
    src = balanced_weights(vectors, label) if balanced else vectors
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=1.0 / max(vectors.count(), 1),
                            standardization=False, weightCol="weight" if balanced else None)
    return SparseLogistic(index, lr.fit(src))
