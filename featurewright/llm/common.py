"""Helpers shared by the llm operators: staging, text buffers, size-checked broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from featurewright.session import checkpoint_dir

#: Bytes on the driver up to which a measured side may be broadcast; beyond them the join shuffles.
BROADCAST_BYTES = 32 << 20
#: The same where the other side is small as well, so that a shuffle costs next to nothing.
LABEL_BYTES = 4 << 20
#: Rows of small staged data that one task takes on.
ROWS_A_TASK = 50_000


def staged(df: DataFrame) -> DataFrame:
    """Cut the lineage: reliable checkpoint in the session's shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(df: DataFrame) -> DataFrame:
    """``df`` staged, in as few partitions as its rows need: light steps on small data get few tasks, large data keeps its own."""
    done = staged(df)
    return done.coalesce(done.count() // ROWS_A_TASK + 1)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in the hash table that the driver builds (key and value row, slots) and what variable-length values hold."""
    size = F.lit(112 + 16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, ArrayType) and f.dataType.elementType.simpleString() in ("int", "bigint", "double", "struct<first:int,last:int>"):
            size = size + F.coalesce(F.greatest(F.size(c), F.lit(0)) * 24, F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (staged) with a broadcast hint if it was measured to hold at most ``limit`` bytes, else as it is."""
    return F.broadcast(df) if (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= limit else df


def new_value(column: str, text_col: str, text: Column, changed: Column, old: Column) -> Column:
    """A document column's value beside a text that may have changed: ``n_chars`` follows it, others stay."""
    if column == text_col:
        return text
    return F.when(changed, F.length(text).cast("long")).otherwise(old) if column == "n_chars" else old


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table_parts(spark: SparkSession) -> int:
    """Number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array and the row offsets in it; null counts as empty."""
    col = pc.fill_null(col, "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64 if pa.types.is_large_string(col.type) else np.int32)
    offs = offs[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if data is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def freeing(fn):
    """``fn`` for mapInArrow, after which the worker gives its freed memory back: workers stay, and so would it."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL(None).malloc_trim(0)

    return run


def row_slices(offs: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row makes a range of its own."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = hi
