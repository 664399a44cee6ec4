"""A feature-store style facade over the operators.

The reference drove its feature tables through a hosted client: create a
table with primary and timestamp keys, write in merge mode, build a training
set from feature lookups, score a batch with automatic lookups.  This class
offers the same call shape on plain Spark catalog tables, so a job written
against that client ports line by line.  Every method is a thin composition
of the distributed operators; nothing is computed on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.operators.asof import Lookup, training_set
from featurewright.operators.history import stamp
from featurewright.operators.models import score
from featurewright.session import materialize
from featurewright.sources import sinks


@dataclass(frozen=True)
class FeatureLookup:
    """What to fetch from a feature table and how to join it (names as in the table)."""

    table_name: str
    feature_names: Sequence[str]
    lookup_key: Sequence[str]
    timestamp_lookup_key: str | None = None


@dataclass
class TrainingSet:
    df: DataFrame

    def load_df(self) -> DataFrame:
        return self.df


class FeatureStore:
    def __init__(self, spark: SparkSession, bucket: str | Sequence[str] = "1 day"):
        self.spark = spark
        self.bucket = bucket

    def create_table(self, name: str, primary_keys: Sequence[str], df: DataFrame,
                     timestamp_keys: Sequence[str] = (), partition_columns: Sequence[str] = (),
                     description: str = "") -> bool:
        """IO6: create (if missing) with a primary-key check; keys kept as table properties."""
        return sinks.create_feature_table(self.spark, name, df, primary_keys, timestamp_keys,
                                          partition_columns, description)

    def write_table(self, name: str, df: DataFrame, mode: str = "merge") -> None:
        """IO7 ``merge`` (upsert by primary key, touched partitions only) or IO5 ``overwrite``."""
        if mode == "merge":
            sinks.write_upsert(self.spark, name, df)
        elif mode == "overwrite":
            # staged first: ``df`` may be derived from the table it replaces
            _, parts = sinks.table_keys(self.spark, name)
            sinks.overwrite_table(materialize(df), name, parts)
        else:
            raise ValueError(f"unknown mode {mode!r}")

    def read_table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def _keys(self, table: str) -> tuple[list[str], list[str]]:
        keys, _ = sinks.table_keys(self.spark, table)
        props = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        ts_keys = [k for k in props.get("featurewright.timestamp_keys", "").split(",") if k]
        return [k for k in keys if k not in ts_keys], ts_keys

    def _lookups(self, feature_lookups: Sequence[FeatureLookup]) -> list[Lookup]:
        out = []
        for fl in feature_lookups:
            table_key, ts_keys = self._keys(fl.table_name)
            if fl.timestamp_lookup_key is None or not ts_keys:
                raise ValueError("point-in-time lookups need a timestamp key on both sides")
            out.append(Lookup(self.read_table(fl.table_name), list(fl.feature_names), list(fl.lookup_key),
                              fl.timestamp_lookup_key, table_key=table_key, table_ts=ts_keys[0]))
        return out

    def _join_key_only(self, df: DataFrame, fl: FeatureLookup) -> DataFrame:
        """A lookup without time: left equi-join on the primary key (unique, so no fan-out)."""
        table_key, _ = self._keys(fl.table_name)
        feats = self.read_table(fl.table_name).select(
            *[F.col(t).alias(b) for t, b in zip(table_key, fl.lookup_key)], *fl.feature_names
        )
        return df.join(feats, list(fl.lookup_key), "left")

    def create_training_set(self, df: DataFrame, feature_lookups: Sequence[FeatureLookup],
                            label: str | None, exclude_columns: Sequence[str] = ()) -> TrainingSet:
        """Base rows + features of every lookup (as-of when timed, else by key), label kept."""
        timed = [fl for fl in feature_lookups if fl.timestamp_lookup_key is not None]
        out = training_set(df, self._lookups(timed), label=label, bucket=self.bucket) if timed else df
        for fl in feature_lookups:
            if fl.timestamp_lookup_key is None:
                out = self._join_key_only(out, fl)
        return TrainingSet(out.drop(*exclude_columns))

    def score_batch(self, model: PipelineModel, df: DataFrame, feature_lookups: Sequence[FeatureLookup],
                    model_version: str, scored_at: str, exclude_columns: Sequence[str] = ()) -> DataFrame:
        """Look the features up as of each row, score, stamp version and time."""
        feats = self.create_training_set(df, feature_lookups, None, exclude_columns).load_df()
        return stamp(score(feats, model), model_version, scored_at)
