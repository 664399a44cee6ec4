"""Feature jobs whose function is named as text.

The function is loaded by module and name, called with keyword arguments, and its
result is checked before the feature table is touched: a frame, with the key and
time columns, of types that can be keys, no null in them, no key twice, no time outside
the window, and, where the table exists, its columns and types.
"""

from __future__ import annotations

import datetime as dt
import inspect
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurewright.operators.asof import interval_micros
from featurewright.session import remove_path, scratch_path
from featurewright.sources.sinks import assert_unique, create_feature_table, table_exists, write_upsert

#: Arguments that every feature function is called with.
ARGUMENTS = ("input_df", "timestamp_column", "start_date", "end_date")


class ContractError(ValueError):
    """A feature function, or its result, that does not keep the contract."""


def load_function(module: str, name: str = "compute_features_fn") -> Callable[..., DataFrame]:
    """The function ``module.name``, if it can be called with the four arguments."""
    try:
        found = getattr(import_module(module), name)
    except ModuleNotFoundError as e:
        raise ContractError(f"no module {module}") from e
    except AttributeError as e:
        raise ContractError(f"module {module} has no {name}") from e
    if not callable(found):
        raise ContractError(f"{module}.{name} is not a function")
    try:
        inspect.signature(found).bind(**dict.fromkeys(ARGUMENTS))
    except TypeError as e:
        raise ContractError(f"{module}.{name} can't be called with {', '.join(ARGUMENTS)}: {e}") from e
    return found


@dataclass(frozen=True)
class FeatureJob:
    """What is computed and where it goes; ``reach`` is how far a feature's time may lie beyond the end (its window)."""

    module: str
    table: str
    keys: Sequence[str]
    timestamp_column: str
    function: str = "compute_features_fn"
    partition_by: Sequence[str] = ()
    reach: str = "1 hour"

    def primary_key(self) -> list[str]:
        return [*self.keys, self.timestamp_column]


def check_schema(spark: SparkSession, job: FeatureJob, features: DataFrame) -> None:
    """Raise ``ContractError`` unless the columns are those of a feature table, and of this one if it exists."""
    if not isinstance(features, DataFrame):
        raise ContractError(f"{job.function} returned {type(features).__name__}, not a DataFrame")
    types = {f.name: f.dataType for f in features.schema.fields}
    if len(types) < len(features.columns):
        raise ContractError("a column name comes twice")
    missing = [c for c in [*job.primary_key(), *job.partition_by] if c not in types]
    if missing:
        raise ContractError(f"columns {missing} are missing")
    if not isinstance(types[job.timestamp_column], (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise ContractError(f"{job.timestamp_column} is {types[job.timestamp_column].simpleString()}, not a time")
    for c in job.keys:
        if isinstance(types[c], (T.MapType, T.NullType, T.FloatType, T.DoubleType)):
            raise ContractError(f"key {c} is {types[c].simpleString()}")
    if table_exists(spark, job.table):
        there = {f.name: f.dataType.simpleString() for f in spark.table(job.table).schema.fields}
        here = {c: t.simpleString() for c, t in types.items()}
        if there != here:
            differ = sorted(c for c in there.keys() | here.keys() if there.get(c) != here.get(c))
            raise ContractError(f"{job.table} differs in {differ}")


def check_rows(job: FeatureJob, features: DataFrame, start: str | None, end: str | None) -> None:
    """Raise ``ContractError`` for null keys, times outside the window (both ends, and the reach), and repeated keys."""
    at = F.unix_micros(F.col(job.timestamp_column).cast("timestamp"))

    def micros(text: str) -> int:
        t = dt.datetime.fromisoformat(str(text))
        t = t.replace(tzinfo=t.tzinfo or dt.timezone.utc)
        return (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)

    outside = F.lit(False)
    if start:
        outside = outside | (at < micros(start))
    if end:
        outside = outside | (at > micros(end) + interval_micros(job.reach))
    no_key = F.lit(False)
    for c in job.primary_key():
        no_key = no_key | F.col(c).isNull()
    row = features.agg(F.count_if(no_key).alias("no_key"), F.count_if(outside).alias("outside")).first()
    if row["no_key"]:
        raise ContractError(f"{row['no_key']} rows lack a key")
    if row["outside"]:
        raise ContractError(f"{row['outside']} rows lie outside {start} to {end}")
    try:
        assert_unique(features, job.primary_key())
    except ValueError as e:
        raise ContractError(str(e)) from e


def run_feature_job(spark: SparkSession, job: FeatureJob, input_df: DataFrame, start_date: str | None = None, end_date: str | None = None) -> None:
    """Load the function, compute, check, then create the feature table or merge into it."""
    compute = load_function(job.module, job.function)
    features = compute(input_df=input_df, timestamp_column=job.timestamp_column, start_date=start_date, end_date=end_date)
    check_schema(spark, job, features)
    path = scratch_path(spark, "features")
    try:
        features.write.parquet(path)  # computed once, checked, then written
        staged = spark.read.schema(features.schema).parquet(path)
        check_rows(job, staged, start_date, end_date)
        if not create_feature_table(spark, job.table, staged, job.keys, [job.timestamp_column], job.partition_by):
            write_upsert(spark, job.table, staged)
    finally:
        remove_path(spark, path)
