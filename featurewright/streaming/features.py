"""Streaming feature and scoring jobs.

R1: the batch window features on a stream - event-time watermark, update
mode, and a ``foreachBatch`` that upserts each micro-batch's changed windows
into the feature table (only the month partitions it touches are rewritten).
R2: a stream of events scored in ``foreachBatch`` with the as-of lookup and a
fitted model, one folder of predictions per epoch.

Both default to ``availableNow`` triggers: drain what is there, then stop, so
a scheduled job resumes from its checkpoint after a failure.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from featurewright.functions.time import epoch_micros, is_weekend, year_month
from featurewright.operators.asof import Lookup, interval_micros
from featurewright.operators.models import score_with_lookup
from featurewright.session import scratch_path
from featurewright.sources.sinks import assert_unique, moved_keys, path_exists, touched_partitions


def stream_source(spark: SparkSession, directory: str, schema: StructType, glob: str | None = None,
                  max_files: int | None = None) -> DataFrame:
    """A parquet file stream; ``glob`` picks files inside ``directory``."""
    reader = spark.readStream.schema(schema).format("parquet")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(directory)


def _event_time(df: DataFrame, ts_col: str) -> DataFrame:
    # Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); with a UTC session the wall clock is unchanged.
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


#: Groups of the pickup windows' state: one packed row each instead of a row per window.
GROUPS = 96
_SLIDE, _SLIDES, _DAY = 15 * 60 * 1_000_000, 4, 24 * 60 * 60 * 1_000_000


def _nullable(values: np.ndarray, null: np.ndarray):
    if values.dtype == object:
        return np.where(null, None, values)
    return (pd.arrays.FloatingArray if values.dtype.kind == "f" else pd.arrays.IntegerArray)(values, null)


def _open_windows(delay: int):
    """Sums and counts per (key, window end) of one group; those that no later row can change leave the state at once."""
    def run(group, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [f for f in frames if len(f)]
        if not rows:
            return
        keys, code, end, total, valued, n, closed = pickle.loads(state.get[0]) if state.exists else (None, *[np.zeros(0, np.int64)] * 2, np.zeros(0), *[np.zeros(0, np.int64)] * 2, None)
        old = len(code)
        col = {c: np.concatenate([f[c].to_numpy() for f in rows]) for c in ("k", "no_k", "day", "at", "v", "no_v")}
        now = state.getCurrentWatermarkMs() * 1000
        closed = now if closed is None else max(closed, now)
        new_code, keys = pd.factorize(col["k"] if keys is None else np.concatenate([keys, col["k"]]))
        new_code = new_code[len(new_code) - len(col["k"]):]
        new_code[col["no_k"].astype(bool)] = -1  # the null key
        ends = (col["at"] // _SLIDE)[:, None] + np.arange(1, _SLIDES + 1)
        mine = (ends * _SLIDE // _DAY * _DAY == col["day"][:, None]) & (ends * _SLIDE > closed)
        row, _ = np.nonzero(mine)
        value, is_value = np.where(col["no_v"].astype(bool), 0.0, col["v"]), (~col["no_v"].astype(bool)).astype(np.int64)
        code, end = np.concatenate([code, new_code[row]]), np.concatenate([end, ends[mine]])
        total, valued = np.concatenate([total, value[row]]), np.concatenate([valued, is_value[row]])
        n = np.concatenate([n, np.ones(len(row), np.int64)])
        changed = np.arange(len(code)) >= old
        if len(code):
            order = np.lexsort((end, code))
            first = np.flatnonzero(np.append(True, (np.diff(code[order]) != 0) | (np.diff(end[order]) != 0)))
            code, end = code[order][first], end[order][first]
            total, valued, n = (np.add.reduceat(x[order], first) for x in (total, valued, n))
            changed = np.logical_or.reduceat(changed[order], first)
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = total / valued
            c = code[changed]
            yield pd.DataFrame({"zip": _nullable(keys[c], c < 0), "end": end[changed] * _SLIDE, "m": _nullable(mean[changed], valued[changed] == 0), "n": n[changed]})
        # the next watermark is not before this one
        closed = max(closed, int(col["at"].max()) - delay)
        left = end * _SLIDE > closed
        used, code = np.unique(code[left], return_inverse=True)
        keys, code = keys[used[used >= 0]], code - int(len(used) > 0 and used[0] < 0)
        state.update((pickle.dumps((keys, code, end[left], total[left], valued[left], n[left], closed)),))

    return run


def stream_pickup_features(src: DataFrame, ts_col: str, zip_col: str, fare_col: str,
                           watermark: str = "1 hour", groups: int = GROUPS) -> DataFrame:
    """R1 (C3 on a stream): 1 h / 15 min sliding mean and count per zip, window end as ts.

    An event opens four windows, so a state with a row per window is several times the events
    of a micro-batch.  Here windows are dealt to ``groups`` by key and day of their end (a
    frequent key is spread), each with its open windows packed into one row; windows that
    the watermark closes after this micro-batch are never stored.  ``groups`` must stay as it is
    for the life of a checkpoint.
    """
    whole = isinstance(src.schema[zip_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    kind, zero = ("bigint", 0) if whole else ("string", "")
    key, fare = F.col(zip_col), F.col(fare_col).cast("double")
    at = epoch_micros(F.col("at"))
    ends = [at - F.pmod(at, F.lit(_SLIDE)) + i * _SLIDE for i in (1, _SLIDES)]
    rows = _event_time(src, ts_col).withWatermark(ts_col, watermark).withColumnRenamed(ts_col, "at").where(F.col("at").isNotNull())
    rows = rows.select(
        "at", at.alias("us"), F.coalesce(key.cast(kind), F.lit(zero).cast(kind)).alias("k"), key.isNull().alias("no_k"),
        F.coalesce(fare, F.lit(0.0)).alias("v"), fare.isNull().alias("no_v"),
        F.explode(F.array_distinct(F.array(*[e - F.pmod(e, F.lit(_DAY)) for e in ends]))).alias("day"),
    ).withColumn("group", F.pmod(F.xxhash64("k", "no_k", "day"), F.lit(groups)))
    rows = rows.select("group", F.col("at").alias("event_time"), F.col("us").alias("at"), "k", "no_k", "day", "v", "no_v")
    agg = rows.groupBy("group").applyInPandasWithState(
        _open_windows(interval_micros(watermark)), f"zip {kind}, end bigint, m double, n bigint", "open binary", "update", GroupStateTimeout.NoTimeout)
    end = F.timestamp_micros("end")
    return agg.select(
        F.col("zip").cast(src.schema[zip_col].dataType).alias("zip"), end.cast("timestamp_ntz").alias(ts_col), year_month(end).alias("yyyy_mm"),
        F.col("m").cast("float").alias("mean_fare_window_1h_pickup_zip"),
        F.col("n").cast("int").alias("count_trips_window_1h_pickup_zip"),
    )


def stream_dropoff_features(src: DataFrame, ts_col: str, zip_col: str, watermark: str = "30 minutes") -> DataFrame:
    """R1 (C2 on a stream): 30-minute tumbling count and weekend flag."""
    ev = _event_time(src, ts_col).withWatermark(ts_col, watermark)
    agg = ev.groupBy(F.col(zip_col).alias("zip"), F.window(ts_col, "30 minutes").alias("window")).agg(
        F.count(F.lit(1)).alias("n")
    )
    end = F.col("window.end")
    return agg.select(
        "zip", end.cast("timestamp_ntz").alias(ts_col), year_month(end).alias("yyyy_mm"),
        F.col("n").cast("int").alias("count_trips_window_30m_dropoff_zip"),
        is_weekend(end).alias("dropoff_is_weekend"),
    )


def _near(batch: DataFrame, keys: Sequence[str]) -> Column:
    """Rows whose key lies between the batch's smallest and largest value of each key column; no other row can have one of its keys."""
    # as a subquery, so that instants are compared as they are in any session zone
    ends = batch.agg(F.struct(*[f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for f, n in ((F.min, "lo"), (F.max, "hi"))]).alias("__ends")).scalar()
    near = F.lit(True)
    for i, k in enumerate(keys):
        near = near & F.coalesce(F.col(k).between(ends.getField(f"lo{i}"), ends.getField(f"hi{i}")), F.lit(False))
    return near


def upsert_into_path(path: str, keys: Sequence[str], partition_col: str | None = "yyyy_mm"):
    """``foreachBatch`` body: merge a micro-batch of changed rows (unique by key) into a parquet feature table.

    Reads only the partitions the batch touches, keeps rows whose key was not
    updated, adds the batch and swaps the partitions in with dynamic partition
    overwrite, which writes beside the table until the job commits.  Where all of the table is
    replaced, the result is staged in the checkpoint folder first.  Re-running a batch after a
    failure gives the same table (idempotent by key).
    """

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.repartition(*keys).persist()  # read several times below, each time by key
        try:
            _merge(spark, batch, epoch_id)
        finally:
            batch.unpersist()

    def _merge(spark: SparkSession, batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        assert_unique(batch, keys)
        whole = False
        if not path_exists(spark, path):
            merged = batch
        else:  # any other read error ends the batch: rows are never taken for missing
            current = spark.read.parquet(path)
            near = _near(batch, keys)
            if partition_col:
                whole = moved_keys(current.where(near), batch, keys, [partition_col])
                current = current if whole else touched_partitions(current, batch, [partition_col])
            # only rows that the batch may update are shuffled
            kept = current.where(near).join(batch.select(*keys), list(keys), "left_anti")
            merged = kept.unionByName(current.where(~near)).unionByName(batch.select(*current.columns))
        whole = whole or not partition_col
        if whole and merged is not batch:
            staged = scratch_path(spark, f"upsert-{epoch_id}")
            merged.write.mode("overwrite").parquet(staged)
            merged = spark.read.parquet(staged)
        # a row that leaves its partition may leave it empty: then all partitions are written
        w = merged.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
        if partition_col:
            w = w.partitionBy(partition_col)
        w.parquet(path)

    return run


def run_feature_stream(features: DataFrame, table_path: str, keys: Sequence[str], checkpoint: str,
                       partition_col: str | None = "yyyy_mm", available_now: bool = True):
    """Start (and with ``availableNow`` drain) R1 into ``table_path``; returns the query handle."""
    writer = (
        features.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert_into_path(table_path, keys, partition_col))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def score_into_path(lookups: Sequence[Lookup], model, out_path: str, model_version: str, scored_at: str,
                    exclude: Sequence[str] = (), fill: float | None = None):
    """``foreachBatch`` body: score a micro-batch into its own ``epoch=<id>`` folder.

    The folder is overwritten, so a batch retried after a failure is not written twice.
    """

    def run(batch: DataFrame, epoch_id: int) -> None:
        scored = score_with_lookup(batch, lookups, model, model_version, scored_at, exclude=exclude, fill=fill)
        scored.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    return run


def run_scoring_stream(src: DataFrame, lookups: Sequence[Lookup], model, out_path: str,
                       checkpoint: str, model_version: str, scored_at: str, exclude: Sequence[str] = (),
                       available_now: bool = True, fill: float | None = None):
    """R2: score each micro-batch with as-of features; one folder of predictions per epoch."""
    run = score_into_path(lookups, model, out_path, model_version, scored_at, exclude, fill)
    writer = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def fresh_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table path and a checkpoint path inside the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-table"), scratch_path(spark, f"{name}-ckpt")
