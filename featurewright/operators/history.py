"""Model history, slowly-changing dimensions and small table verbs
(SURVEY C5, C6, W1, W2, W4, A19, U1, U2, P8, P10, P11, P13, P14, IO7/J8).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurewright.functions.scalar import json_map, match_any
from featurewright.functions.time import epoch_micros
from featurewright.operators.asof import NESTED_BUCKETS, bucket_widths
from featurewright.operators.scan import row_index
from featurewright.sources.tables import ts_literal


# ---------------------------------------------------------------- small verbs
def stack(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position over any number of frames (one union, not a fold of jobs)."""
    return reduce(lambda a, b: a.union(b), dfs)


def stack_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    return a.unionByName(b, allowMissingColumns=True)


def project_excluding(df: DataFrame, exclude: Sequence[str] = (), first: Sequence[str] = ()) -> DataFrame:
    """P10: put ``first`` columns in front and drop ``exclude``."""
    rest = [c for c in df.columns if c not in set(exclude) | set(first)]
    return df.select(*first, *rest)


def drop_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns (missing names are ignored, as ``DataFrame.drop`` does)."""
    return df.drop(*cols)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Blanks in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def stamp(df: DataFrame, model_version: str | int, scored_at: str) -> DataFrame:
    """Lineage constants - model version and scoring time (a parameter, not now())."""
    return df.withColumns(
        {
            "model_version": F.lit(str(model_version)),
            "inference_timestamp": F.to_timestamp_ntz(F.lit(scored_at)),
        }
    )


def pack_features(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    """Pack feature columns into one struct column (model input)."""
    return df.withColumn(name, F.struct(*[F.col(c) for c in cols]))


def filter_names(df: DataFrame, col: str, patterns: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` matches any of the patterns."""
    return df.where(match_any(col, patterns))


# ---------------------------------------------------------------- model runs
def latest_version(models: DataFrame, name_col: str = "model_name", version_col: str = "version",
                   stage_col: str | None = None, stage: str | None = None) -> DataFrame:
    """Highest integer version per model (optionally within one stage)."""
    src = models if stage is None or stage_col is None else models.where(F.col(stage_col) == stage)
    return src.groupBy(name_col).agg(F.max(F.col(version_col).cast("long")).alias("latest_version"))


def running_min_before(
    df: DataFrame, keys: Sequence[str], order_ts: str, tie: str, value: str,
    bucket: str | Sequence[str] = NESTED_BUCKETS,
) -> DataFrame:
    """Min of ``value`` over all earlier rows of the same key (exclusive), as ``prev_min``.

    A per-key window would put a hot key into one task.  Rows are bucketed by
    time instead (one width or a coarse-to-fine list, as for the as-of lookup):
    a window over (key, finest bucket) gives the in-bucket running min, and each
    level adds the min of earlier buckets inside its parent bucket from one row
    per active bucket.  Min is associative, so the levels combine with ``least``; every window is bounded by the ratio of
    adjacent widths (the coarsest by span / width), not by the data.
    """
    widths = bucket_widths(bucket)
    bcols = [f"__b{i}" for i in range(len(widths))]
    us = epoch_micros(order_ts)
    b = df.withColumns({c: F.floor(us / F.lit(w)) for c, w in zip(bcols, widths)})
    w_in = Window.partitionBy(*keys, bcols[-1]).orderBy(order_ts, tie).rowsBetween(Window.unboundedPreceding, -1)
    out = b.withColumn("__in", F.min(value).over(w_in))
    prev = F.col("__in")
    for lvl in range(len(widths) - 1, -1, -1):
        own, parent = bcols[: lvl + 1], bcols[:lvl]
        per_bucket = b.groupBy(*keys, *own).agg(F.min(value).alias("__bmin"))
        w_carry = Window.partitionBy(*keys, *parent).orderBy(own[-1]).rowsBetween(Window.unboundedPreceding, -1)
        carry = per_bucket.select(*keys, *own, F.min("__bmin").over(w_carry).alias(f"__carry{lvl}"))
        out = out.join(carry, [*keys, *own], "left")
        prev = F.least(prev, F.col(f"__carry{lvl}"))
    return out.withColumn("prev_min", prev).drop(*bcols, "__in", *[f"__carry{i}" for i in range(len(widths))])


def champion_history(
    runs: DataFrame,
    model_col: str = "model_name",
    order_col: str = "created",
    run_col: str = "run_id",
    metric_col: str = "metric",
    bucket: str | Sequence[str] = NESTED_BUCKETS,
) -> DataFrame:
    """Replay the promotion rule over a model's runs in time order.

    The first run becomes champion (and its own challenger).  A later run
    becomes champion only if its metric is strictly greater than every earlier
    run's; the champion it replaces - the earliest run holding that earlier
    maximum - becomes challenger.  Runs at one instant follow their run ids.  A
    null or NaN metric counts as lower than any number: such a run is champion
    only as a model's first, until a run with a number follows.

    The running minimum is taken over ``struct(-metric, time, run)``, so it
    carries the run id of the earliest holder and no self-join is needed.  Adds
    ``is_champion`` (0/1) and ``challenger_run_id`` (null for other runs).
    """
    metric = F.col(metric_col).cast("double")
    cost = F.when(metric.isNull() | F.isnan(metric), F.lit(float("inf"))).otherwise(-metric)
    holder = F.struct(cost.alias("c"), epoch_micros(order_col).alias("t"), F.col(run_col).alias("r"))
    r = running_min_before(runs.withColumn("__holder", holder), [model_col], order_col, run_col, "__holder",
                           bucket)
    prev = F.col("prev_min")
    is_champ = prev.isNull() | (cost < prev.getField("c"))
    challenger = F.when(~is_champ, F.lit(None).cast("string")).when(
        prev.isNull(), F.col(run_col)).otherwise(prev.getField("r"))
    return r.select(
        *runs.columns,
        is_champ.cast("int").alias("is_champion"),
        challenger.alias("challenger_run_id"),
    )


def current_aliases(history: DataFrame, model_col: str = "model_name", order_col: str = "created",
                    run_col: str = "run_id") -> DataFrame:
    """Champion and Challenger run per model after the replay: (model, alias, run_id)."""
    latest = history.where(F.col("is_champion") == 1).groupBy(model_col).agg(
        F.max_by(F.struct(run_col, "challenger_run_id"), F.struct(order_col, run_col)).alias("__last")
    )
    return latest.select(
        model_col,
        F.explode(F.array(
            F.struct(F.lit("Champion").alias("alias"), F.col(f"__last.{run_col}").alias(run_col)),
            F.struct(F.lit("Challenger").alias("alias"), F.col("__last.challenger_run_id").alias(run_col)),
        )).alias("__a"),
    ).select(model_col, "__a.alias", f"__a.{run_col}")


def run_snapshot(
    runs: DataFrame,
    as_of: str,
    created_millis: str = "created_ms",
    updated_millis: str = "updated_ms",
    profile_json: str = "dataset_profile",
) -> DataFrame:
    """One row per (model, alias) with metrics, params, profile map and SCD columns.

    Input columns: run_id, experiment_id, run_name, alias, model_name, version,
    created_ms, updated_ms (epoch millis), metrics (map), params (map),
    dataset_profile (JSON text), dataset_source.  ``as_of`` is the ingestion
    time (F10: a parameter, so reruns are reproducible).
    """
    created = F.timestamp_millis(F.col(created_millis))
    updated = F.timestamp_millis(F.col(updated_millis))
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return runs.select(
        "run_id", "experiment_id", "run_name", "alias", "model_name", "version",
        F.date_format(created, fmt).alias("created_timestamp"),
        F.date_format(updated, fmt).alias("last_updated_timestamp"),
        ts_literal(as_of).alias("ingestion_time"),
        "metrics", "params",
        json_map(profile_json).alias("dataset_profile"),
        "dataset_source",
        F.lit("Y").alias("active_flag"),
        F.to_date(created).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
    )


# ---------------------------------------------------------------- SCD2 / upsert
def scd2_merge(
    stored: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    as_of: str,
    changed_only: bool = False,
    compare: Sequence[str] = (),
    id_col: str = "id",
) -> DataFrame:
    """Close matching stored rows, append incoming rows as new versions, re-key.

    Parity (Q7): every stored row whose key is in ``incoming`` gets
    ``end_date = as_of`` and ``active_flag = 'N'`` - closed rows too - and every
    incoming row is inserted.  ``changed_only``: only active rows whose
    ``compare`` columns differ are closed, and only changed or new keys are
    inserted, so each key keeps exactly one active row.

    One left join of the stored rows against the incoming keys replaces the
    MERGE (unsupported on parquet).  Ids that are 0 to n - 1 keep their order, so
    stored rows keep theirs and only inserted rows are numbered, from n on in key
    order.  Where stored ids have gaps, repeats or nulls, all rows are numbered anew.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hits, insert = scd2_changes(stored, incoming, keys, changed_only, compare)
    closed = scd2_closed(stored, hits, keys, as_of, changed_only)
    return scd2_numbered(stored, closed, scd2_new_rows(stored, insert, as_of, id_col), keys, id_col)


def scd2_changes(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], changed_only: bool, compare: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct keys whose stored rows are closed, incoming rows that are inserted)"""
    if not changed_only:
        return incoming.select(*keys).distinct(), incoming
    active = stored.where(F.col("active_flag") == "Y")
    diff = F.lit(False) if compare else F.lit(True)
    for c in compare:
        diff = diff | ~F.col(f"__s.{c}").eqNullSafe(F.col(f"__i.{c}"))
    same_key = [F.col(f"__s.{k}") == F.col(f"__i.{k}") for k in keys]
    changed = active.alias("__s").join(incoming.alias("__i"), same_key, "inner").where(diff).select(*[F.col(f"__s.{k}").alias(k) for k in keys])
    new = incoming.select(*keys).join(active.select(*keys), list(keys), "left_anti")
    return changed.distinct(), incoming.join(changed.unionByName(new), list(keys), "left_semi")


def scd2_closed(stored: DataFrame, hits: DataFrame, keys: Sequence[str], as_of: str, only_active: bool) -> DataFrame:
    """The stored rows, those of the hit keys (with ``only_active`` their active ones) closed on ``as_of``."""
    s = stored.join(hits.withColumn("__hit", F.lit(True)), list(keys), "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    if only_active:
        hit = hit & (F.col("active_flag") == "Y")
    return s.withColumns({
        "end_date": F.when(hit, F.to_date(F.lit(as_of))).otherwise(F.col("end_date")),
        "active_flag": F.when(hit, F.lit("N")).otherwise(F.col("active_flag")),
    }).select(*stored.columns)


def scd2_new_rows(stored: DataFrame, insert: DataFrame, as_of: str, id_col: str) -> DataFrame:
    """Inserted rows in the stored columns, without an id yet."""
    return insert.withColumns({
        id_col: F.lit(None).cast("long"), "active_flag": F.lit("Y"),
        "start_date": F.to_date(F.lit(as_of)), "end_date": F.lit(None).cast("date"),
    }).select(*stored.columns)


def dense_ids(df: DataFrame, id_col: str = "id") -> int | None:
    """n where the ids are 0 to n - 1, each once, in any order; else None.

    One aggregate: besides number, smallest and largest, the sum of the ids' 64-bit
    hashes equals that of the numbers themselves (repeats and gaps that keep it
    are as unlikely as a hash collision).  No id is moved or sorted.
    """
    total = F.sum(F.xxhash64(F.col(id_col).cast("long")).cast("decimal(38,0)"))
    n, ids, low, high, have = df.agg(F.count(F.lit(1)), F.count(id_col), F.min(id_col), F.max(id_col), total).first()
    if n == 0:
        return 0
    if ids != n or low != 0 or high != n - 1:
        return None
    numbers = df.sparkSession.range(n).select(F.col("id").alias(id_col))
    return n if numbers.agg(total).first()[0] == have else None


def scd2_numbered(stored: DataFrame, closed: DataFrame, new_rows: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Closed and new rows, the new ones numbered from the high-water mark; all anew where stored ids are not dense."""
    start = dense_ids(stored, id_col)
    if start is None:
        return rekey(closed.unionByName(new_rows), id_col, tie=keys)
    numbered = row_index(new_rows.drop(id_col), [F.col(k).asc() for k in keys], id_col, start=start)
    return closed.withColumn(id_col, F.col(id_col).cast("long")).unionByName(numbered.select(*closed.columns))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """IO7/J8: target rows without an update (left anti join) plus all updates."""
    return target.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)


def rekey(df: DataFrame, id_col: str = "id", tie: Sequence[str] = ()) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY id NULLS LAST) - 1`` without a single-task window."""
    order: list[Column] = [F.col(id_col).asc_nulls_last(), *[F.col(t).asc() for t in tie]]
    return row_index(df.withColumnRenamed(id_col, "__old"), [F.col("__old").asc_nulls_last(), *order[1:]],
                     id_col).drop("__old").select(*df.columns)
