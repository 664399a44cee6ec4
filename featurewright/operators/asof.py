"""Point-in-time (as-of) lookups and training sets.

For every base row, take the feature row with the same key and the greatest
feature timestamp ``<=`` the base row's lookup timestamp; no match gives nulls.
The whole feature row is taken as one struct (never the last non-null value
per column).

Plan, designed so no task ever holds an unbounded group, even when one key
carries a third of all rows:

1. Probe points: distinct ``(key, ts)`` of the base (partial aggregation on the
   map side).  A hot key is spread over many tasks by ``ts``.
2. Time buckets ``b = floor(ts / width)``, one or several nested levels.
   Features and probe points of one ``(key, finest b)`` are unioned and
   scanned with a running ``last(struct)``: features sort before probes at
   equal instants, which gives ``<=``.  A group holds at most the distinct
   instants of one key within one finest bucket.
3. Carry-in: the last feature of earlier buckets.  ``max_by`` per
   ``(key, bucket)`` (partial aggregation), then a running ``last`` over the
   buckets of one parent bucket (or of the key, at the coarsest level).  Each
   such window holds at most (parent width / width) rows, or span / width at
   the top - bounded independent of the data volume.
4. Answer = in-bucket match, else carry-in; joined back to the base rows on
   ``(key, ts)`` (the answer side is unique per key, so AQE can split a skewed
   base partition safely).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurewright.functions.time import epoch_micros

_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def interval_micros(spec: str) -> int:
    """``"1 day"`` / ``"6 hours"`` / ``"15 minutes"`` to microseconds."""
    n, unit = spec.split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _US[unit])


@dataclass(frozen=True)
class Lookup:
    """Declarative lookup spec, like a feature-store ``FeatureLookup``.

    ``lookup_key`` / ``timestamp_lookup_key`` name base columns;
    ``table_key`` / ``table_ts`` name the feature table's key and timestamp
    (defaults: the same names as on the base side).
    """

    table: DataFrame
    features: Sequence[str]
    lookup_key: Sequence[str]
    timestamp_lookup_key: str
    table_key: Sequence[str] | None = None
    table_ts: str | None = None
    rename: dict[str, str] = field(default_factory=dict)


# Nested bucket widths that bound every window at any key density: a day has 1,440 minutes, a month 30 days.
NESTED_BUCKETS = ("30 days", "1 day", "1 minute")


def bucket_widths(bucket: str | Sequence[str]) -> list[int]:
    widths = [interval_micros(bucket)] if isinstance(bucket, str) else [interval_micros(b) for b in bucket]
    for coarse, fine in zip(widths, widths[1:]):
        if coarse % fine:
            raise ValueError("each bucket width must divide the previous (coarser) one")
    return widths


def asof_answers(
    base: DataFrame,
    lookups: Sequence[Lookup],
    embargo: str | None = None,
    bucket: str | Sequence[str] = "1 day",
) -> DataFrame:
    """J5 core: one answer per lookup and distinct probe point ``(key, ts)`` of ``base``.

    The lookups share their key columns; each is a number ``__lk`` beside the key,
    so all of them go through one union, one shuffle by (key, lookup, bucket) and
    one carry.  ``bucket`` is one width or a coarse-to-fine list such as
    ``NESTED_BUCKETS``.  Of features at one (key, instant) the largest struct
    counts.  The running ``last`` runs per (key, lookup, finest bucket); level
    ``i`` carries the last feature of earlier level-``i`` buckets inside the same
    level-``i-1`` bucket, so every window partition is bounded by the ratio of
    adjacent widths (the coarsest by span / width).  The answer is the in-bucket
    hit, else the finest carry, else coarser ones.

    Returns ``__k0.., __lk, __t, __f`` (a struct of one struct per lookup), dealt
    by (key, ts).  ``base`` and the feature tables should be scans or materialized
    tables - never the output of another lookup.
    """
    n_keys = len(lookups[0].lookup_key)
    kcols = [f"__k{i}" for i in range(n_keys)]
    ts_type = base.schema[lookups[0].timestamp_lookup_key].dataType.simpleString()
    structs = []
    for lk in lookups:
        fields = {f.name: f.dataType for f in lk.table.schema.fields}
        structs.append("struct<" + ",".join(f"`{lk.rename.get(f, f)}`:{fields[f].simpleString()}" for f in lk.features) + ">")
    def timed(rows: DataFrame) -> DataFrame:
        """Null keys and times match nothing.  They go here, and buckets are never null: a filter that the optimizer
        would infer from one of the joins below would make that branch's shuffle a different one."""
        return rows.where(reduce(lambda p, c: p & F.col(c).isNotNull(), kcols, F.col("__t").isNotNull()))

    parts = []
    for i, lk in enumerate(lookups):
        f_t = F.col(lk.table_ts or lk.timestamp_lookup_key).cast(ts_type)
        if embargo:
            f_t = f_t + F.expr(f"INTERVAL {embargo}")
        own = F.struct(*[F.col(f).alias(lk.rename.get(f, f)) for f in lk.features]).cast(structs[i])
        found = F.struct(*[(own if j == i else F.lit(None).cast(structs[j])).alias(f"f{j}") for j in range(len(lookups))])
        parts.append(timed(lk.table.select(*[F.col(c).alias(k) for c, k in zip(lk.table_key or lk.lookup_key, kcols)], F.lit(i).alias("__lk"),
                                           f_t.alias("__t"), found.alias("__f"), F.lit(False).alias("__probe"))))
    widths = bucket_widths(bucket)
    bcols = [f"__b{i}" for i in range(len(widths))]
    group = [*kcols, "__lk"]
    # One probe per instant, combined on the map side.  Feature rows are keyed by their instants and go without.
    null_f = F.lit(None).cast(parts[0].schema["__f"].dataType)
    points = F.explode(F.array(*[F.struct(F.lit(i).alias("__lk"), F.col(lk.timestamp_lookup_key).alias("__t")) for i, lk in enumerate(lookups)])).alias("__p")
    probes = timed(base.select(*[F.col(c).alias(k) for c, k in zip(lookups[0].lookup_key, kcols)], points).select(*kcols, "__p.*")).distinct()
    parts.append(probes.select(*group, "__t", null_f.alias("__f"), F.lit(True).alias("__probe")))
    # Dealt by (key, lookup, finest bucket), once for all that follows.
    us = epoch_micros("__t")
    dealt = reduce(DataFrame.unionByName, parts).withColumns(
        {b: F.coalesce(F.floor(us / F.lit(w)), F.lit(0)) for b, w in zip(bcols, widths)}).repartition(*group, bcols[-1])

    # At one instant features come before the probe, the largest last.
    w_in = Window.partitionBy(*group, bcols[-1]).orderBy("__t", "__probe", "__f").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = dealt.withColumn("__hit", F.last("__f", ignorenulls=True).over(w_in)).where("__probe").select(*group, *bcols, "__t", "__hit")

    # Carry per level, finest first: one row per active bucket.
    answer = F.col("__hit")
    for lvl in range(len(widths) - 1, -1, -1):
        own, parent = bcols[: lvl + 1], bcols[:lvl]
        has = F.col("__f").isNotNull()
        active = dealt.groupBy(*group, *own).agg(
            F.max_by("__f", F.when(has, F.struct("__t", "__f"))).alias("__last"), F.max("__probe").alias("__probe"))
        w_carry = Window.partitionBy(*group, *parent).orderBy(own[-1]).rangeBetween(Window.unboundedPreceding, -1)
        carry = (active.withColumn(f"__carry{lvl}", F.last("__last", ignorenulls=True).over(w_carry))
                 .where("__probe").select(*group, *own, f"__carry{lvl}"))
        answers = answers.join(carry, [*group, *own])
        answer = F.coalesce(answer, F.col(f"__carry{lvl}"))

    return answers.select(*group, "__t", answer.alias("__f")).repartition(*kcols, "__t")


def attach(base: DataFrame, lookups: Sequence[Lookup], answers: DataFrame) -> DataFrame:
    """Join answers back to the base rows on (key, ts), lookup by lookup; the answer side is unique per key."""
    # The number is hidden behind a term that can't be known before the job runs: a filter on it would
    # otherwise move below the shuffles, and each lookup would compute its answers with shuffles of its own.
    answers = answers.withColumn("__lk", F.col("__lk") + F.floor(F.rand(0)).cast("int"))
    out = base
    for i, lookup in enumerate(lookups):
        out = _attach_one(out, lookup, answers.where(F.col("__lk") == i).withColumn("__f", F.col(f"__f.f{i}")))
    return out


def _attach_one(base: DataFrame, lookup: Lookup, answers: DataFrame) -> DataFrame:
    keys = list(lookup.lookup_key)
    ts = lookup.timestamp_lookup_key
    out_names = [lookup.rename.get(f, f) for f in lookup.features]
    clash = set(out_names) & set(base.columns)
    if clash:
        raise ValueError(f"feature columns already in base: {sorted(clash)}")
    kcols = [f"__k{i}" for i in range(len(keys))]
    b = base.alias("__base")
    a = answers.alias("__ans")
    cond = [F.col(f"__base.{c}") == F.col(f"__ans.{k}") for c, k in zip(keys, kcols)]
    cond.append(F.col(f"__base.{ts}") == F.col("__ans.__t"))
    return b.join(a, cond, "left").select(
        *[F.col(f"__base.{c}") for c in base.columns],
        *[F.col("__ans.__f").getField(o).alias(o) for o in out_names],
    )


def asof_lookup(
    base: DataFrame,
    lookup: Lookup,
    embargo: str | None = None,
    bucket: str | Sequence[str] = "1 day",
) -> DataFrame:
    """Add ``lookup.features`` to ``base`` as of ``lookup.timestamp_lookup_key``.

    ``embargo`` (e.g. ``"15 minutes"``) makes a feature row usable only that
    long after its timestamp, which removes the label leakage of window-end
    stamped features (SURVEY Q5).  Default: none, as in the reference.
    """
    return attach(base, [lookup], asof_answers(base, [lookup], embargo, bucket))


def training_set(
    base: DataFrame,
    lookups: Sequence[Lookup],
    label: str | None = None,
    exclude_columns: Sequence[str] = (),
    embargo: str | None = None,
    bucket: str | Sequence[str] = "1 day",
) -> DataFrame:
    """As-of lookups, the label kept, excluded columns dropped.

    Lookups by the same key columns are answered together (``asof_answers``), from
    the original ``base`` (a scan), never from another lookup's output; the answers
    are then joined on one after the other.
    """
    together: dict[tuple, list[Lookup]] = {}
    for lk in lookups:
        together.setdefault((tuple(lk.lookup_key), base.schema[lk.timestamp_lookup_key].dataType.simpleString()), []).append(lk)
    out = base
    for group in together.values():
        out = attach(out, group, asof_answers(base, group, embargo=embargo, bucket=bucket))
    names = [lk.rename.get(f, f) for lk in lookups for f in lk.features]
    out = out.select(*base.columns, *names)
    if label is not None and label not in out.columns:
        raise ValueError(f"label column {label!r} not in base")
    return out.drop(*exclude_columns)
