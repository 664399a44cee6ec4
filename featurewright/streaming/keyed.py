"""Streaming scoring from keyed state.

Feature rows and events are one stream.  A key's feature rows live in the state
store, so a micro-batch shuffles its own rows only, however long the feature tables
are.  An event gets, of each lookup's feature rows with the same key, the latest
one not after its lookup time among all that have arrived with or before its
micro-batch: the batch as-of lookup, if features arrive no later than the
events that need them.

A state holds what a later event can ask for: rows younger than ``max_age`` before
the newest one, and the one that was valid then.  Keys are kept in ``BUCKETS`` groups by
their hash, each with the histories of its keys.  A key without new rows for
``max_age`` beyond the watermark is evicted.  Rows older than ``max_age`` are not used,
evicted or not, so results do not depend on when eviction happens.  Without
``max_age`` any age counts and nothing is evicted.

Rows behind the watermark are dropped by the stateful operator; streams that must
keep them go through ``late.admit`` first.  An event with a null key or lookup time
finds nothing.  The state is in the query's checkpoint: a restarted query goes on
with it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from featurewright.functions.time import epoch_micros, from_epoch_micros
from featurewright.operators.asof import interval_micros
from featurewright.operators.history import stamp
from featurewright.operators.models import score, score_struct


#: Groups of the stateful operator.  Each costs Spark some ten milliseconds of Python a micro-batch, so keys share them.
BUCKETS = 1024


@dataclass(frozen=True)
class StreamLookup:
    """A feature stream (key, ts, features), and the event column that its rows are looked up by."""

    table: DataFrame
    features: Sequence[str]
    key: str
    ts: str
    lookup_ts: str
    rename: dict[str, str] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [self.rename.get(f, f) for f in self.features]


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _zero(t: T.DataType):
    """What stands in for null in a column that pandas would otherwise turn into floats; None if it need not."""
    return 0 if isinstance(t, (*_WHOLE, T.FloatType, T.DoubleType)) else False if isinstance(t, T.BooleanType) else None


def _is_time(t: T.DataType) -> bool:
    return isinstance(t, (T.TimestampType, T.TimestampNTZType))


def _plain(events: DataFrame) -> list[tuple[T.DataType, Column]]:
    """Type and column of each field, instants as microseconds: flat columns that Arrow hands over without a Python object per value."""
    return [(T.LongType(), epoch_micros(F.col(f"`{f.name}`"))) if _is_time(f.dataType) else (f.dataType, F.col(f"`{f.name}`")) for f in events.schema.fields]


def _merged(events: DataFrame, key: str, lookups: Sequence[StreamLookup], delay: str) -> DataFrame:
    """One stream of flat rows: feature rows of lookup 0.., events with lookup -1.

    k, at, lookup; times t0.. and no0.. (there is none); values v0..; the event's columns e0.. and, for those
    of a type that has a zero, null0..: whether it stands for null.
    """
    key_type = events.schema[key].dataType
    width = max(len(x.features) for x in lookups)
    last = F.array_max(F.array(*[F.col(x.lookup_ts) for x in lookups]))
    times = [epoch_micros(x.lookup_ts) for x in lookups]
    cells, none = [], []
    for j, (kind, column) in enumerate(_plain(events)):
        zero = _zero(kind)
        if zero is None:
            cells.append(column.alias(f"e{j}"))
            none.append(F.lit(None).cast(kind).alias(f"e{j}"))
        else:
            cells += [F.coalesce(column, F.lit(zero).cast(kind)).alias(f"e{j}"), column.isNull().alias(f"null{j}")]
            none += [F.lit(zero).cast(kind).alias(f"e{j}"), F.lit(True).alias(f"null{j}")]
    rows = events.select(F.col(key).cast("string").alias("k"), last.cast("timestamp").alias("at"), F.lit(-1).alias("lookup"),
                         *[c for i, t in enumerate(times) for c in (F.coalesce(t, F.lit(0)).alias(f"t{i}"), t.isNull().alias(f"no{i}"))],
                         *[F.lit(None).cast("double").alias(f"v{i}") for i in range(width)], *cells)
    for i, x in enumerate(lookups):
        t = epoch_micros(x.ts)
        own = [F.col(f).cast("double") for f in x.features] + [F.lit(None).cast("double")] * (width - len(x.features))
        rows = rows.unionByName(x.table.select(
            F.col(x.key).cast(key_type).cast("string").alias("k"), F.col(x.ts).cast("timestamp").alias("at"), F.lit(i).alias("lookup"),
            F.coalesce(t, F.lit(0)).alias("t0"), t.isNull().alias("no0"),
            *[c for n in range(1, len(lookups)) for c in (F.lit(0).cast("bigint").alias(f"t{n}"), F.lit(True).alias(f"no{n}"))],
            *[c.alias(f"v{n}") for n, c in enumerate(own)], *none))
    return rows.withWatermark("at", delay)


def _nullable(values: np.ndarray, null: np.ndarray):
    kind = pd.arrays.BooleanArray if values.dtype.kind == "b" else pd.arrays.FloatingArray if values.dtype.kind == "f" else pd.arrays.IntegerArray
    return kind(values, null)


class _History:
    """Feature rows of one key and lookup: times rising, one row per time (the last to arrive)."""

    def __init__(self, at: np.ndarray, values: np.ndarray):
        self.at, self.values = at, values

    def with_rows(self, at: np.ndarray, values: np.ndarray) -> _History:
        at, values = np.concatenate([self.at, at]), np.concatenate([self.values, values])
        order = np.argsort(at, kind="stable")
        at, values = at[order], values[order]
        last = np.append(at[1:] != at[:-1], True) if len(at) else np.zeros(0, bool)
        return _History(at[last], values[last])

    def as_of(self, at: np.ndarray, max_age: int | None) -> np.ndarray:
        place = np.searchsorted(self.at, at, side="right") - 1
        out = np.full((len(at), self.values.shape[1]), np.nan)
        found = place >= 0
        if max_age is not None and found.any():
            found[found] = at[found] - self.at[place[found]] < max_age
        out[found] = self.values[place[found]]
        return out

    def kept(self, max_age: int | None) -> _History:
        if max_age is None or not len(self.at):
            return self
        first = max(0, int(np.searchsorted(self.at, self.at[-1] - max_age, side="right")) - 1)
        return _History(self.at[first:], self.values[first:])


def _by_key(codes: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The rows of each key, in their order."""
    rows = rows[np.argsort(codes[rows], kind="stable")]
    return np.split(rows, np.flatnonzero(np.diff(codes[rows])) + 1) if len(rows) else []


def _updater(widths: list[int], columns: list[str], masked: list[bool], names: list[str], max_age: int | None):
    """The state of a bucket: each of its keys with one history per lookup."""
    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = pickle.loads(state.get[0]) if state.exists else {}
        asked = []
        for frame in frames if not state.hasTimedOut else ():
            kind = frame["lookup"].to_numpy()
            codes, keys = pd.factorize(frame["k"].to_numpy())  # -1: a null key finds nothing and leaves nothing
            at, usable = frame["t0"].to_numpy(np.int64), (codes >= 0) & ~frame["no0"].to_numpy(bool)
            for i, w in enumerate(widths):
                new = np.flatnonzero((kind == i) & usable)
                if not len(new):
                    continue
                values = np.column_stack([frame[f"v{j}"].to_numpy(np.float64) for j in range(w)])
                for rows in _by_key(codes, new):
                    own = known.setdefault(keys[codes[rows[0]]], [_History(np.zeros(0, np.int64), np.zeros((0, n))) for n in widths])
                    own[i] = own[i].with_rows(at[rows], values[rows])
            events = np.flatnonzero(kind == -1)
            if len(events):
                asked.append(frame if len(events) == len(frame) else frame.iloc[events])
        for events in asked:
            codes, keys = pd.factorize(events["k"].to_numpy())
            out = {c: _nullable(events[f"e{j}"].to_numpy(), events[f"null{j}"].to_numpy(bool)) if m else events[f"e{j}"].to_numpy()
                   for j, (c, m) in enumerate(zip(columns, masked))}
            at = 0
            for i, w in enumerate(widths):
                times, found = events[f"t{i}"].to_numpy(np.int64), np.full((len(events), w), np.nan)
                for rows in _by_key(codes, np.flatnonzero((codes >= 0) & ~events[f"no{i}"].to_numpy(bool))):
                    if own := known.get(keys[codes[rows[0]]]):
                        found[rows] = own[i].as_of(times[rows], max_age)
                out |= {names[at + j]: found[:, j] for j in range(w)}  # NaN is handed back as null
                at += w
            yield pd.DataFrame(out)
        known = {k: [h.kept(max_age) for h in own] for k, own in known.items()}
        if max_age is not None:
            ends = {k: max(int(h.at[-1]) for h in own if len(h.at)) + max_age for k, own in known.items()}
            now = state.getCurrentWatermarkMs()
            known = {k: own for k, own in known.items() if ends[k] > now * 1000}
        if not known:
            if state.exists:
                state.remove()
            return
        state.update((pickle.dumps(known),))
        if max_age is not None:
            state.setTimeoutTimestamp(max(min(ends[k] for k in known) // 1000, now + 1))

    return run


def lookup_stream(events: DataFrame, key: str, lookups: Sequence[StreamLookup], delay: str = "1 day", max_age: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The event stream's columns and the looked-up features (double; null where there is none).

    The state is kept per bucket of keys; ``buckets`` must stay as it is for the life of a checkpoint.
    """
    rows, plain = _merged(events, key, lookups, delay), [kind for kind, _ in _plain(events)]
    names = [n for x in lookups for n in x.names()]
    columns = [f"e{j}" for j in range(len(plain))]
    schema = T.StructType([*(T.StructField(c, kind) for c, kind in zip(columns, plain)), *(T.StructField(n, T.DoubleType()) for n in names)])
    run = _updater([len(x.features) for x in lookups], columns, [_zero(kind) is not None for kind in plain], names, interval_micros(max_age) if max_age else None)
    timeout = GroupStateTimeout.EventTimeTimeout if max_age else GroupStateTimeout.NoTimeout
    found = rows.withColumn("bucket", F.pmod(F.xxhash64("k"), F.lit(buckets))).groupBy("bucket").applyInPandasWithState(run, schema, "history binary", "append", timeout)
    back = [from_epoch_micros(F.col(c), isinstance(f.dataType, T.TimestampNTZType)) if _is_time(f.dataType) else F.col(c)
            for c, f in zip(columns, events.schema.fields)]
    return found.select(*[c.alias(f.name) for c, f in zip(back, events.schema.fields)], *names)


def run_keyed_scoring_stream(events: DataFrame, key: str, lookups: Sequence[StreamLookup], model, out_path: str, checkpoint: str, model_version: str,
                             scored_at: str, exclude: Sequence[str] = (), fill: float | None = None, delay: str = "1 day",
                             max_age: str | None = None, available_now: bool = True):
    """R2 from keyed state: every micro-batch's events looked up, scored and written to its own ``epoch=<id>`` folder."""
    names = [n for x in lookups for n in x.names()]
    found = lookup_stream(events, key, lookups, delay, max_age).drop(*exclude)

    def run(batch: DataFrame, epoch_id: int) -> None:
        feats = batch.fillna(fill, subset=names) if fill is not None else batch
        scored = score(feats, model) if hasattr(model, "transform") else score_struct(feats, model, names)
        stamp(scored, model_version, scored_at).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    writer = found.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(run)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
