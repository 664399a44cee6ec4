"""Exact keyed splits and samples.

A key's place is a 60-bit hash of its text and a seed, the same in any engine.
The test side, or the sample, holds exactly the k keys of smallest hash.  The k-th
is found without a sort: a histogram of the hash's top bits says which bucket
it lies in, a second one refines that bucket, and so on; each is a grouped count
of at most ``2 ** LEVEL_BITS`` rows.  Keys of one hash value are told apart by
their text.  The result is a projection of the input: a hash and a comparison.

A null key is one key.  Rows of one key stay together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurewright.session import remove_path, scratch_path

HASH_BITS, LEVEL_BITS = 60, 15


def key_text(key: str | Column | Sequence[str]) -> Column:
    """The key as text; of several columns each value with its length, so that no two keys share a text."""
    if isinstance(key, (str, Column)):
        c = F.col(key) if isinstance(key, str) else key
        return F.coalesce(c.cast("string"), F.lit("\0"))
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in key]
    return F.concat_ws(",", *parts)


def text_hash(text: Column, seed: int) -> Column:
    """First 15 hex digits of md5(text:seed) as a number."""
    return F.conv(F.substring(F.md5(F.concat(text, F.lit(f":{seed}"))), 1, HASH_BITS // 4), 16, 10).cast("bigint")


@dataclass(frozen=True)
class Threshold:
    """The chosen keys: hash below ``hash``, or equal to it and text up to ``text`` (None: all of that hash)."""

    keys: int
    chosen: int
    hash: int
    text: str | None = None

    def holds(self, text: Column, seed: int, hash_of: Callable[[Column, int], Column] = text_hash) -> Column:
        h = hash_of(text, seed)
        if self.text is None:
            return h <= F.lit(self.hash)
        return (h < F.lit(self.hash)) | ((h == F.lit(self.hash)) & (text <= F.lit(self.text)))


def smallest(keys: DataFrame, wanted: Callable[[int], int]) -> Threshold:
    """Threshold of the ``wanted(number of keys)`` smallest rows of ``keys`` (text, h; each key once)."""
    prefix, shift = 0, HASH_BITS - LEVEL_BITS
    inside, total, chosen, left = keys, None, 0, 0
    while True:
        bucket = F.shiftright("h", shift).bitwiseAND((1 << LEVEL_BITS) - 1)
        counts = sorted((r["b"], r["n"]) for r in inside.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect())
        if total is None:
            total = sum(n for _, n in counts)
            left = chosen = min(max(wanted(total), 0), total)
            if chosen == 0:
                return Threshold(total, 0, -1)
        for b, n in counts:
            if left <= n:
                break
            left -= n
        prefix = prefix << LEVEL_BITS | b
        if left == n:
            return Threshold(total, chosen, ((prefix + 1) << shift) - 1)
        if shift == 0:
            last = inside.where(F.col("h") == prefix).orderBy("text").limit(left).agg(F.max("text")).first()[0]
            return Threshold(total, chosen, prefix, last)
        inside = keys.where(F.col("h").between(prefix << shift, ((prefix + 1) << shift) - 1))
        shift -= LEVEL_BITS


def threshold(df: DataFrame, key: str | Column | Sequence[str], wanted: Callable[[int], int], seed: int = 0,
              hash_of: Callable[[Column, int], Column] = text_hash) -> Threshold:
    """``smallest`` over the distinct keys of a frame, which are staged once as (text, hash)."""
    path = scratch_path(df.sparkSession, "keys")
    texts = df.select(key_text(key).alias("text")).distinct()
    try:
        texts.select("text", hash_of(F.col("text"), seed).alias("h")).write.parquet(path)
        return smallest(df.sparkSession.read.schema("text string, h bigint").parquet(path), wanted)
    finally:
        remove_path(df.sparkSession, path)


def exact_split(df: DataFrame, key: str | Column | Sequence[str], test_size: float = 0.3, seed: int = 0, col: str = "split",
                hash_of: Callable[[Column, int], Column] = text_hash) -> DataFrame:
    """Exactly ceil(test_size * keys) keys on the test side, another choice for each seed."""
    t = threshold(df, key, lambda n: math.ceil(test_size * n), seed, hash_of)
    return df.withColumn(col, F.when(t.holds(key_text(key), seed, hash_of), F.lit("test")).otherwise(F.lit("train")))


def exact_sample(df: DataFrame, key: str | Column | Sequence[str], fraction: float = 0.25, seed: int = 0, env: str = "dev",
                 hash_of: Callable[[Column, int], Column] = text_hash) -> DataFrame:
    """The rows of exactly round(fraction * keys) keys outside prod (halves to the even number)."""
    if env == "prod":
        return df
    t = threshold(df, key, lambda n: round(fraction * n), seed, hash_of)
    return df.where(t.holds(key_text(key), seed, hash_of))
