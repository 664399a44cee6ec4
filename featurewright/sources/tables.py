"""Sources.

Readers return lazy DataFrames; column pruning and the filters below reach
the parquet scan (``PushedFilters`` / ``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared test tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """IO2: scan a path table (Delta is not on the classpath; parquet is the default)."""
    return spark.read.format(fmt).load(path)


def read_sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """IO3: the result of an SQL string over registered views/tables; ``:name`` markers are bound from ``params``."""
    return spark.sql(query, args=params) if params else spark.sql(query)


def ts_literal(value) -> Column:
    """A bound for a timestamp column: Column as is, date/datetime as a literal, text as TIMESTAMP_NTZ."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        return F.lit(value)
    return F.lit(str(value)).cast("timestamp_ntz")


def scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    entity_col: str | None = None,
    entity=None,
    ts_col: str | None = None,
    since=None,
) -> DataFrame:
    """IO1/P2: column projection, entity equality and a lower time bound.

    The bound is compared against the raw column (never a cast of it), so the
    predicate is pushed into the parquet reader.
    """
    out = df
    if entity_col is not None and entity is not None:
        out = out.where(F.col(entity_col) == F.lit(entity))
    if ts_col is not None and since not in (None, ""):
        out = out.where(F.col(ts_col) >= ts_literal(since))
    if columns is not None:
        out = out.select(*columns)
    return out


# Cells keep outer blanks; an empty text is written quoted and a null as \\N, so both come back as they were.
LISTING_CSV = {
    "header": "true", "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_listing_csv(df: DataFrame, path: str, rows_a_file: int = 100_000) -> None:
    """IO4: a CSV folder that ``read_listing_csv`` reads back cell for cell (a text that is exactly ``\\N`` excepted).

    A file with cells of several lines is read by one task, so files hold ``rows_a_file`` rows at most.
    """
    df.write.options(**LISTING_CSV | {"emptyValue": '""'}).option("maxRecordsPerFile", rows_a_file).csv(path)


def infer_csv_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> str:
    """IO4 helper: infer the listing CSV schema once and return it as JSON text.

    Store the text next to the job; later runs pass ``schema_from_json(text)``
    so production reads never pay the inference pass again.
    """
    reader = spark.read.options(**LISTING_CSV, multiLine="true", inferSchema="true")
    return reader.option("samplingRatio", str(sampling_ratio)).csv(path).schema.json()


def schema_from_json(text: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(text))


def read_listing_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """IO4: header CSV with multi-line quoted cells and ``"`` escapes.

    Pass ``schema`` in production: inference is an extra full pass over the
    files.  Without it, the schema is inferred once.
    """
    reader = spark.read.options(**LISTING_CSV, multiLine="true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)
