"""Sinks: catalog tables and partitioned directories.

Writes never read their own target in the same plan: when a new version is
derived from the table it replaces, the new version is first cut from its
lineage with a reliable checkpoint in the shared checkpoint folder.  Upserts
rewrite only the partitions they touch (dynamic partition overwrite).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.operators.history import dense_ids, scd2_changes, scd2_closed, scd2_merge, scd2_new_rows, scd2_numbered, upsert
from featurewright.operators.scan import surrogate_id
from featurewright.session import materialize, remove_path, scratch_path


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Primary-key check: one aggregate, at most one offending key comes back."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dict(dup[0].asDict())} for primary key {list(keys)}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists in its file system; other errors are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def moved_keys(current: DataFrame, updates: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> bool:
    """Whether an update takes a key to another partition (keys and partition columns only are read)."""
    if set(parts) <= set(keys):
        return False
    new = updates.select(*keys, F.struct(*parts).alias("__new"))
    return not current.select(*dict.fromkeys([*keys, *parts])).join(new, list(keys)).where(
        ~F.struct(*parts).eqNullSafe(F.col("__new"))
    ).isEmpty()


def touched_partitions(current: DataFrame, updates: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The current rows in the partitions that the updates touch, as a filter the scan can prune on.

    The distinct partition values come to the driver: as many as partitions are rewritten.
    """
    values = updates.select(*parts).distinct().collect()
    wanted = F.lit(False)
    for v in values:
        same = F.lit(True)
        for c in parts:
            same = same & (F.col(c).isNull() if v[c] is None else F.col(c) == F.lit(v[c]))
        wanted = wanted | same
    return current.where(wanted)


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """IO5: replace table contents and schema; the table's own keys and other library properties stay."""
    spark = df.sparkSession
    props = {}
    if table_exists(spark, name):
        rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        props = {r["key"]: r["value"] for r in rows if r["key"].startswith("featurewright.")}
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    if props:
        props["featurewright.partition_by"] = ",".join(partition_by)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in props.items()) + ")")


def create_feature_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    keys: Sequence[str],
    timestamp_keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    description: str = "",
) -> bool:
    """IO6: create database and feature table if missing; primary key = keys + timestamp keys.

    Returns True when the table was created.  Keys are stored as table
    properties so later upserts can read them.
    """
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if table_exists(spark, name):
        return False
    pk = [*keys, *timestamp_keys]
    assert_unique(df, pk)
    overwrite_table(df, name, partition_by)
    props = {
        "featurewright.primary_keys": ",".join(pk),
        "featurewright.timestamp_keys": ",".join(timestamp_keys),
        "featurewright.partition_by": ",".join(partition_by),
        "comment": description,
    }
    spark.sql(
        f"ALTER TABLE {name} SET TBLPROPERTIES ("
        + ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
        + ")"
    )
    return True


def table_partitions(spark: SparkSession, name: str) -> list[str]:
    """The table's partition columns."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def table_keys(spark: SparkSession, name: str) -> tuple[list[str], list[str]]:
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    pk = [k for k in props.get("featurewright.primary_keys", "").split(",") if k]
    parts = [k for k in props.get("featurewright.partition_by", "").split(",") if k]
    return pk, parts


def write_upsert(spark: SparkSession, name: str, updates: DataFrame) -> None:
    """IO7: merge-mode write into a feature table without a MERGE engine.

    Only partitions that receive updates are read and rewritten: current rows
    of those partitions minus updated keys (left anti join) plus the updates,
    checkpointed, then written with dynamic partition overwrite.  If an update
    takes a key to another partition, all partitions are rewritten, as the one it
    leaves may get empty.
    """
    keys, parts = table_keys(spark, name)
    if not keys:
        raise ValueError(f"{name} has no primary key")
    updates = materialize(updates)  # read several times below: computed once
    assert_unique(updates, keys)
    current = spark.table(name)
    whole = not parts or moved_keys(current, updates, keys, parts)
    if not whole:
        current = touched_partitions(current, updates, parts)
    merged = upsert(current, updates.select(*current.columns), keys)
    _replace(spark, name, merged.select(*spark.table(name).columns), "static" if whole else "dynamic")


def _replace(spark: SparkSession, name: str, df: DataFrame, mode: str) -> None:
    """Insert-overwrite by position: all partitions (static) or those that the rows touch (dynamic).

    The rows are staged first.  The mode is a setting that no write option of
    ``insertInto`` stands for, so a session of its own writes: the caller's
    settings count for nothing here and are not changed.
    """
    path = scratch_path(spark, "replace")
    try:
        df.write.parquet(path)
        writer = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(key):
                writer.conf.set(key, value)
        writer.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        writer.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
        writer.read.schema(df.schema).parquet(path).write.insertInto(name, overwrite=True)
    finally:
        spark.catalog.refreshTable(name)
        remove_path(spark, path)


def write_history(spark: SparkSession, name: str, incoming: DataFrame, key: str | Sequence[str], as_of: str, changed_only: bool = False,
                  compare: Sequence[str] = (), id_col: str = "id") -> bool:
    """C5 on a table: merge ``incoming`` into its history; True where only touched partitions were rewritten.

    Touched are the partitions that hold rows to close and those that new rows
    belong to.  The whole table is rewritten where it has no partitions, where closing
    moves rows (partitions by flag or end date), or where ids are not dense.
    """
    keys, parts, stored = [key] if isinstance(key, str) else list(key), table_partitions(spark, name), spark.table(name)
    incoming = materialize(incoming)
    if not parts or {"active_flag", "end_date"} & set(parts) or dense_ids(stored, id_col) is None:
        _replace(spark, name, scd2_merge(stored, incoming, keys, as_of, changed_only, compare, id_col).select(*stored.columns), "static")
        return False
    hits, insert = (materialize(x) for x in scd2_changes(stored, incoming, keys, changed_only, compare))
    new_rows = scd2_new_rows(stored, insert, as_of, id_col)
    closing = stored.where(F.col("active_flag") == "Y") if changed_only else stored
    touched = closing.join(hits, keys, "left_semi").select(*parts).unionByName(new_rows.select(*parts))
    closed = scd2_closed(touched_partitions(stored, touched, parts), hits, keys, as_of, changed_only)
    _replace(spark, name, scd2_numbered(stored, closed, new_rows, keys, id_col).select(*stored.columns), "dynamic")
    return True


def refresh(spark: SparkSession, name: str, df: DataFrame) -> None:
    """IO8: truncate-and-load by position (the table keeps its schema).

    The new rows are staged first and then written with insert-overwrite (which
    replaces the old rows of all partitions, whatever the session's overwrite mode), so
    a frame derived from the table itself never reads a table that was already emptied.
    """
    _replace(spark, name, df, "static")


def rewrite(spark: SparkSession, name: str, df: DataFrame) -> None:
    """IO9: insert-overwrite by position; a frame derived from the table is staged first."""
    _replace(spark, name, df, "static")


def create_with_id(spark: SparkSession, name: str, df: DataFrame, keys: Sequence[str], id_col: str = "id") -> None:
    """IO10: create a table from the frame's schema with a leading bigint surrogate id."""
    with_id = surrogate_id(df, keys, id_col)
    overwrite_table(with_id.select(id_col, *[c for c in df.columns if c != id_col]), name)


def write_split(df: DataFrame, root: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """IO11: features and label in one table partitioned by the split column."""
    df.write.mode(mode).partitionBy(split_col).parquet(root)


def load_split(spark: SparkSession, root: str, which: str, split_col: str = "split") -> DataFrame:
    """IO12: one side of the split; the filter prunes partitions at planning time."""
    return spark.read.parquet(root).where(F.col(split_col) == which)
