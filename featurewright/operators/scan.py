"""Global ordered scans without a single-task window.

``ROW_NUMBER() OVER (ORDER BY ...)`` with no partition runs in one task.  Here
the rows are range-partitioned on the order, sorted inside each partition, and
numbered locally; per-partition counts (one row per partition) give the
offsets, which are joined back (AQE broadcasts what it measured to be small).  Same numbers, full
parallelism.

The numbered frame is checkpointed (reliably, in the shared checkpoint folder)
before its counts are taken: the counts and the numbering must come from one
and the same range partitioning, and two separately planned branches may
sample different range bounds.  The checkpoint survives executor loss and
leaves nothing cached behind.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from featurewright.session import materialize

_PID_SHIFT = 1 << 33  # monotonically_increasing_id = (partition << 33) + row in partition


def _ranged(df: DataFrame, order: Sequence[Column | str], num_partitions: int | None) -> DataFrame:
    """Range-partition and sort on ``order``.

    Without an explicit count the range shuffle starts at
    ``spark.sql.shuffle.partitions`` and AQE may coalesce it to the data size;
    the numbering below reads the partition ids after coalescing, so it stays
    consistent either way.
    """
    ranged = df.repartitionByRange(int(num_partitions), *order) if num_partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def row_index(
    df: DataFrame,
    order: Sequence[Column | str],
    id_col: str = "id",
    start: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Dense 0-based (or ``start``-based) index in ``order``.

    Equal to ``row_number() over (order by ...) - 1 + start``; rows tied on the
    whole order get distinct, arbitrary numbers (give a unique order for
    reproducible ids).
    """
    ranged = _ranged(df, order, num_partitions)
    tagged = materialize(
        ranged.withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id())
    )
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        F.coalesce(
            F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("__off"),
    )
    out = tagged.join(offsets, "__pid")
    local = F.col("__mid") - F.col("__pid").cast("long") * F.lit(_PID_SHIFT)
    return out.withColumn(id_col, F.col("__off") + local + F.lit(start)).drop(
        "__pid", "__mid", "__off"
    )


def surrogate_id(df: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """Deterministic bigint id from the business key order (not partition order)."""
    return row_index(df, [F.col(k).asc_nulls_last() for k in keys], id_col)


def prefix_sums(
    df: DataFrame,
    order: Sequence[str],
    value_cols: Sequence[str],
    num_partitions: int | None = None,
) -> DataFrame:
    """Exclusive running sums of ``value_cols`` in global ``order``.

    Adds ``before_<col>`` = sum of ``col`` over all rows strictly earlier in the
    order.  The in-partition scan is a vectorised pandas ``cumsum`` per Arrow
    batch; the partition carry comes from one row per partition.
    """
    ranged = _ranged(df, order, num_partitions)
    schema = StructType(
        list(ranged.schema.fields)
        + [StructField("__pid", LongType())]
        + [StructField(f"__loc_{c}", DoubleType()) for c in value_cols]
    )
    cols = list(value_cols)

    def scan(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        carry = {c: 0.0 for c in cols}
        for pdf in batches:
            pdf = pdf.copy()
            pdf["__pid"] = pid
            for c in cols:
                v = pd.to_numeric(pdf[c], errors="coerce").fillna(0.0).astype("float64")
                cum = v.cumsum() - v + carry[c]
                carry[c] += float(v.sum())
                pdf[f"__loc_{c}"] = cum
            yield pdf

    local = materialize(ranged.mapInPandas(scan, schema))
    totals = local.groupBy("__pid").agg(*[F.sum(c).alias(f"__tot_{c}") for c in cols])
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__pid", *[F.coalesce(F.sum(f"__tot_{c}").over(w), F.lit(0.0)).alias(f"__off_{c}") for c in cols]
    )
    out = local.join(offsets, "__pid")
    return out.select(
        *df.columns,
        *[(F.col(f"__off_{c}") + F.col(f"__loc_{c}")).alias(f"before_{c}") for c in cols],
    )
