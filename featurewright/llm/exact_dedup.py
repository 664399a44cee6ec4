"""Exact dedup by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes says so, so equal
texts are cut alike.  Its recipe is the ordered list of its chunks' digests.
The bytes of each distinct chunk are moved once, to find out whether a digest
stands for one content only; where it does not, the contents under it are
numbered.  Texts are equal exactly if their ordered lists of verified
identifiers (digest, number) are.  Long texts are never moved or compared
whole: groups are formed on the lists.

Plan: scan -> recipes (checkpoint, no text); scan -> chunks -> aggregation on
(digest, bytes), map-side combined, so thousands of copies leave one row a
task; lists -> aggregation -> join back on the list (the copies' side of a hot
list is split by AQE's skew join: the other side has one row per list).

Null text counts as empty.  A null id is smaller than any other.  Of rows that
share text and id one stays.  Empty texts equal each other (one empty chunk).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurewright.llm.common import documents, freeing, row_slices, staged, utf8

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 1024, 32768, 12
_GEAR = np.random.default_rng(20).integers(0, 2**32, 256, dtype=np.uint32)


def cut_points(buf: np.ndarray) -> np.ndarray:
    """Positions after which a chunk may end: the gear hash of the last 32 bytes has CUT_BITS zeros."""
    h = _GEAR[buf]
    for s in (1, 2, 4, 8, 16):
        nxt = h.copy()
        nxt[s:] += h[:-s] << np.uint32(s)
        h = nxt
    return np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1


def chunk_bounds(cuts: np.ndarray, lo: int, hi: int) -> list[int]:
    """Chunk ends of the text in [lo, hi): first cut at least MIN_CHUNK on, at most MAX_CHUNK."""
    ends, at = [], lo
    while hi - at > MIN_CHUNK:
        k = int(np.searchsorted(cuts, at + MIN_CHUNK))
        end = min(int(cuts[k]) if k < len(cuts) else hi, at + MAX_CHUNK, hi)
        ends.append(end)
        at = end
    if at < hi or not ends:
        ends.append(hi)
    return ends


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _chunks(batch, digest):
    """(row, its bytes, its chunks as (digest, bytes)) of a batch's text column, the last one."""
    buf, offs = utf8(batch.column(batch.num_columns - 1))
    for lo, hi in row_slices(offs, 4 << 20):
        part = buf[offs[lo]:offs[hi]]
        cuts, raw, base = cut_points(part), part.tobytes(), offs[lo]
        for r in range(lo, hi):
            a, b = int(offs[r] - base), int(offs[r + 1] - base)
            out, at = [], a
            for end in chunk_bounds(cuts, a, b):
                c = raw[at:end]
                out.append((_signed(digest(c)), c))
                at = end
            yield r, raw[a:b], out


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=xxhash.xxh3_64_intdigest
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    ``digest`` maps chunk bytes to 64 bits; a bad one costs time, not results.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def recipe(batches):
        for b in batches:
            sha, lists = [], []
            for _, raw, chunks in _chunks(b, digest):
                sha.append(hashlib.sha256(raw).hexdigest())
                lists.append([d for d, _ in chunks])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sha, pa.string()), pa.array(lists, pa.list_(pa.int64()))],
                ["doc_id", "text_sha256", "digests"],
            )

    id_type = src.schema["doc_id"].dataType.simpleString()
    recipes = staged(
        src.mapInArrow(freeing(recipe), f"doc_id {id_type}, text_sha256 string, digests array<bigint>")
        .withColumn("row", F.monotonically_increasing_id())
    )

    def chunks(batches):
        for b in batches:
            ds, cs, size = [], [], 0
            for _, _, got in _chunks(b, digest):
                for d, c in got:
                    ds.append(d)
                    cs.append(c)
                    size += len(c)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(ds, pa.int64()), pa.array(cs, pa.binary())], ["digest", "chunk"])
                    ds, cs, size = [], [], 0
            if ds:
                yield pa.RecordBatch.from_arrays([pa.array(ds, pa.int64()), pa.array(cs, pa.binary())], ["digest", "chunk"])

    contents = src.select("text").mapInArrow(freeing(chunks), "digest bigint, chunk binary").groupBy("digest", "chunk").agg(
        F.count(F.lit(1)).alias("n")
    )
    shared = staged(contents.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1"))
    if shared.isEmpty():  # every digest was verified to stand for one content
        named = recipes.withColumn("numbers", F.lit(None).cast("array<bigint>"))
    else:
        named = _numbered(src, recipes, contents.join(shared, "digest", "left_semi"), shared, digest)

    groups = named.groupBy(F.col("digests").alias("g_digests"), F.col("numbers").alias("g_numbers")).agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "row")).alias("last"),
    )
    same = (F.col("digests") == F.col("g_digests")) & F.col("numbers").eqNullSafe(F.col("g_numbers"))
    return named.join(groups, same).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("last.row") == F.col("row")).alias("kept"),
        "text_sha256",
        F.size("digests").cast("long").alias("n_chunks"),
    )


def _numbered(src: DataFrame, recipes: DataFrame, contents: DataFrame, shared: DataFrame, digest) -> DataFrame:
    """Recipes with each chunk's number among the contents of its digest (0 where there is one)."""
    by = Window.partitionBy("digest").orderBy("chunk")
    numbers = contents.select("digest", "chunk", F.row_number().over(by).cast("long").alias("number"))

    # the chunks under a shared digest are looked up by content; the text's hash ties them to their recipe
    def occurrences(batches):
        for b in batches:
            rows = [(hashlib.sha256(raw).hexdigest(), i, d, c) for _, raw, got in _chunks(b, digest) for i, (d, c) in enumerate(got)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                ["text_sha256", "at", "digest", "chunk"],
            )

    occ = src.select("text").mapInArrow(occurrences, "text_sha256 string, at int, digest bigint, chunk binary")
    found = (
        occ.join(shared.select("digest"), "digest", "left_semi").distinct()
        .join(numbers, ["digest", "chunk"])
        .groupBy("text_sha256").agg(F.map_from_entries(F.collect_list(F.struct("at", "number"))).alias("found"))
    )
    return recipes.join(found, "text_sha256", "left").withColumn(
        "numbers",
        F.transform("digests", lambda _, i: F.coalesce(F.col("found")[i], F.lit(0).cast("long"))),
    ).drop("found")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).drop("n_chunks")


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
