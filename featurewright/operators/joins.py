"""Keyed joins with residual time predicates and semi/anti joins.

All are equi-joins on the key with the time condition kept as a residual, so
Spark plans a hash-partitioned (or, when AQE sees a small side, broadcast)
join; AQE's skew handling splits a hot key's partition on the large side.
Callers pre-aggregate the large side to one row per (key, instant) first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def events_until(
    events: DataFrame, ref: DataFrame, keys: Sequence[str], ts_col: str, bound_col: str
) -> DataFrame:
    """Events of each key with ``ts <= ref.bound`` (inner join, inclusive)."""
    e, r = events.alias("__e"), ref.alias("__r")
    cond = _on(e, r, keys) & (F.col(f"__e.{ts_col}") <= F.col(f"__r.{bound_col}"))
    extra = [F.col(f"__r.{c}") for c in ref.columns if c not in keys and c not in events.columns]
    return e.join(r, cond, "inner").select("__e.*", *extra)


def events_between(
    events: DataFrame, ref: DataFrame, keys: Sequence[str], ts_col: str, lo_col: str, hi_col: str
) -> DataFrame:
    """Events of each key with ``lo <= ts <= hi`` (both inclusive)."""
    e, r = events.alias("__e"), ref.alias("__r")
    cond = (
        _on(e, r, keys)
        & (F.col(f"__e.{ts_col}") >= F.col(f"__r.{lo_col}"))
        & (F.col(f"__e.{ts_col}") <= F.col(f"__r.{hi_col}"))
    )
    extra = [F.col(f"__r.{c}") for c in ref.columns if c not in keys and c not in events.columns]
    return e.join(r, cond, "inner").select("__e.*", *extra)


def assemble(base: DataFrame, groups: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-outer star assembly of feature groups onto a base, on ``keys``."""
    out = base
    for g in groups:
        out = out.join(g, list(keys), "left")
    return out


def rows_for_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys_df`` - a left-semi join, never collect + isin."""
    return df.join(keys_df.select(*keys), list(keys), "left_semi")
