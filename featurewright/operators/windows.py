"""Time filters and time-window aggregates.

Window aggregates are one ``groupBy(key, window(ts, ...))``: Spark expands each
row to its windows inside the scan stage, aggregates partially on the map side
(so a hot key is combined before it is shuffled) and shuffles on
``(key, window)``, which spreads a hot key across partitions by time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurewright.sources.tables import ts_literal


def filter_by_ts(df: DataFrame, ts_col: str | None, start=None, end=None) -> DataFrame:
    """Keep ``start <= ts < end``; a missing or empty bound is no bound."""
    out = df
    if ts_col and start not in (None, ""):
        out = out.where(F.col(ts_col) >= ts_literal(start))
    if ts_col and end not in (None, ""):
        out = out.where(F.col(ts_col) < ts_literal(end))
    return out


def _aggs(aggs: Sequence[Column] | None) -> list[Column]:
    return list(aggs) if aggs else [F.count(F.lit(1)).alias("count")]


def tumbling(
    df: DataFrame, keys: Sequence[str], ts_col: str, length: str, aggs: Sequence[Column] | None = None
) -> DataFrame:
    """A1: aggregates per key and tumbling window; returns ``window`` + aggregates."""
    return df.groupBy(*keys, F.window(ts_col, length).alias("window")).agg(*_aggs(aggs))


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    length: str,
    slide: str,
    aggs: Sequence[Column] | None = None,
) -> DataFrame:
    """A2: aggregates per key and sliding window (each row in length/slide windows)."""
    return df.groupBy(*keys, F.window(ts_col, length, slide).alias("window")).agg(*_aggs(aggs))


def sliding_mean_count_presliced(
    df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str, slices: int, slide_minutes: int
) -> DataFrame:
    """A2 variant: pre-aggregate to slide-sized slices, then combine ``slices`` of them.

    Same result as ``sliding`` for mean and count (mean = sum / count), but the
    first shuffle carries one row per (key, slice) instead of ``slices`` rows.
    Returns ``keys``, ``window_end``, ``sum_v``, ``n``.
    """
    slide = f"{slide_minutes} minutes"
    pre = df.groupBy(*keys, F.window(ts_col, slide).alias("w")).agg(
        F.sum(value_col).alias("s"), F.count(F.lit(1)).alias("c"), F.count(value_col).alias("cv")
    )
    offsets = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("o")
    expanded = pre.select(*keys, "w", "s", "c", "cv", offsets).select(
        *keys,
        F.timestamp_add("MINUTE", F.col("o") * slide_minutes, F.col("w.end")).alias("window_end"),
        "s", "c", "cv",
    )
    return expanded.groupBy(*keys, "window_end").agg(
        F.sum("s").alias("sum_v"), F.sum("c").alias("n"), F.sum("cv").alias("n_value")
    )
