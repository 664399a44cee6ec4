"""Exact-substring dedup: suffix arrays by external induced sorting over what can repeat at all.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  Equal strings have equal content, so also an equal
smallest gram hash (``GRAM`` bytes): neighbouring strings of a document share
it over a stretch, and a stretch can only repeat where its hash recurs.

Documents are dealt to buckets by a hash of id and text; this one shuffle serves
all steps, and what goes between them are packed arrays per bucket, not rows per
document or stretch.

1. A bucket's distinct stretch hashes go, packed per part of the hash space, to
   tasks that tell each bucket which of its hashes recur: those that another
   bucket sends too, or that the bucket marks as held by two of its documents.
2. Buckets meet their recurring hashes; the stretches concerned, 50 to about
   80 bytes each, are dealt to shards by hash: equal strings share a shard.
3. Each shard sorts the suffixes of its distinct stretches by external induced
   sorting (``induced_sort``).  Neighbours with a common prefix of ``LENGTH``
   form a class; its smallest id decides which documents' copies go.
4. Buckets meet their documents' removed ranges.

Null text is empty; texts shorter than ``LENGTH`` lose nothing.  A null id is
larger than any other; rows that share an id don't remove each other's bytes.

Ids only tell which document is smaller.  A row is known by two 64-bit hashes of
its id and text, ``row`` and ``check``.  Rows equal in id and text have the same
ranges and share a bucket; they count once there, however many there are.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from featurewright.llm.common import documents, row_slices, table_parts, utf8
from featurewright.llm.induced_sort import equal_prefixes, suffix_array
from featurewright.llm.near_dedup import _BYTE, _mix, _powers

LENGTH, GRAM, SLICE, SHARDS = 50, 20, 2 << 20, 4
_NO_ID = 2**63 - 1


def stretches(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first string's start in the row, number of strings, hash) of the stretches of strings that share their smallest gram hash."""
    n = len(buf) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    up, down = _powers(1 << max(16, int(len(buf)).bit_length()))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=sums[1:])
    h = _mix((sums[gram:] - sums[:-gram]) * down[:len(buf) - gram + 1])
    wide, span = length - gram + 1, 1
    while span * 2 <= wide:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if wide > span:
        h = np.minimum(h[:span - wide], h[wide - span:])
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:n]
    ok = np.arange(n) + length <= offs[row + 1]
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (h[1:n] != h[:n - 1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    ends = np.cumsum(ok)
    count = np.diff(np.append(ends[first] - 1, ends[-1]))
    return row[first], first - offs[row[first]], count, h[first]


def _pack(*arrays: np.ndarray) -> bytes:
    return struct.pack("<q", len(arrays[0])) + b"".join(a.tobytes() for a in arrays)


def _unpack(blobs, *dtypes) -> tuple[list[np.ndarray], list[bytes]]:
    """Columns over all blobs, and what follows them in each blob."""
    cols, rest = [[np.zeros(0, d)] for d in dtypes], []
    for b in blobs:
        (n,), at = struct.unpack_from("<q", b), 8
        for c, d in zip(cols, dtypes):
            c.append(np.frombuffer(b, d, n, at))
            at += n * np.dtype(d).itemsize
        rest.append(b[at:])
    return [np.concatenate(c) for c in cols], rest


def _groups(keys: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal values."""
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)])) if len(keys) else []


def _distinct(*cols: np.ndarray) -> list[np.ndarray]:
    """The distinct rows, in ascending order."""
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.ones(len(order), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return [c[new] for c in cols]


def _first_copies(ids: np.ndarray) -> np.ndarray:
    """True where a value occurs for the first time."""
    first = np.zeros(len(ids), bool)
    first[np.unique(ids, return_index=True)[1]] = True
    return first


def _runs_of(key: np.ndarray, *cols: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The keys and, packed, their columns."""
    order = np.argsort(key, kind="stable")
    key, cols = key[order], [c[order] for c in cols]
    runs = _groups(key)
    return [int(key[a]) for a, _ in runs], [_pack(*(c[a:b] for c in cols)) for a, b in runs]


def _ints(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy().astype(np.int64, copy=False)


def _once(t: pa.Table) -> np.ndarray:
    """The bucket's rows, each of those that are equal in id and text once; all of them if another text has the same hash."""
    return _first_copies(_mix(_ints(t, "row").view(np.uint64)) ^ _ints(t, "check").view(np.uint64))


def _bucket_stretches(t: pa.Table):
    """(rows of a slice, its bytes, their offsets, stretches) of the bucket, a bounded slice at a time; copies have none."""
    buf, offs = utf8(t.column("text"))
    once = _once(t)
    for lo, hi in row_slices(offs, SLICE):
        part, at = buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        found = stretches(part, at)
        if not once[lo:hi].all():
            mine = once[lo:hi][found[0]]
            found = tuple(x[mine] for x in found)
        yield lo, part, at, found


def _sent(parts: int):
    """Step 1, at a bucket: (part, bucket, blob): its hashes of each part, and bits that tell which two of its documents hold."""
    def run(t: pa.Table) -> pa.Table:
        hs, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for lo, _, _, (row, _, _, h) in _bucket_stretches(t):
            hs.append(h)
            rows.append(row + lo)
        h, row = _distinct(np.concatenate(hs), np.concatenate(rows))
        head = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
        several = np.diff(np.append(np.flatnonzero(head), len(h))) > 1
        h = h[head]
        part = (h % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        keys, blobs = [], []
        for a, z in _groups(part[order]):
            keys.append(int(part[order[a]]))
            blobs.append(_pack(h[order[a:z]]) + np.packbits(several[order[a:z]]).tobytes())
        bucket = t.column("bucket")[0].as_py()
        return pa.table({"part": pa.array(keys, pa.int64()), "bucket": pa.array([bucket] * len(keys), pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


def _recurring(t: pa.Table) -> pa.Table:
    """Step 1, at a part: (bucket, those of its hashes that recur)."""
    hs, marks, owners = [], [], []
    for k, blob in enumerate(t.column("blob").to_pylist()):
        (h,), (bits,) = _unpack([blob], np.uint64)
        hs.append(h)
        marks.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(h)).astype(bool))
        owners.append(np.full(len(h), k, np.int64))
    h, mark, owner = np.concatenate(hs), np.concatenate(marks), np.concatenate(owners)
    order = np.argsort(h, kind="stable")
    s = h[order]
    head = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    size = np.diff(np.append(head, len(s)))
    again = np.zeros(len(h), bool)
    again[order] = np.repeat((size > 1) | np.logical_or.reduceat(mark[order], head), size)
    keys, blobs = _runs_of(owner[again], h[again])
    buckets = t.column("bucket").to_pylist()
    return pa.table({"bucket": pa.array([buckets[k] for k in keys], pa.int64()), "blob": pa.array(blobs, pa.binary())})


def _dealt(shards: int):
    """Step 2: (shard, blob of the bucket's stretches of recurring hashes, with their bytes)."""
    def run(t: pa.Table, recur: pa.Table) -> pa.Table:
        out: tuple[list, list] = [], []
        (wanted,), _ = _unpack(recur.column("blob").to_pylist(), np.uint64)
        if t.num_rows and len(wanted):
            rows, checks, keys = (_ints(t, c) for c in ("row", "check", "key"))
            for lo, part, at, (row, start, count, h) in _bucket_stretches(t):
                keep = np.isin(h, wanted)
                row, start, count, h = row[keep], start[keep], count[keep], h[keep]
                shard = (_mix(h) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                for a, z in _groups(shard[order]):
                    o = order[a:z]
                    size = count[o] + LENGTH - 1
                    first = at[row[o]] + start[o]
                    index = np.repeat(first - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
                    used, place = np.unique(row[o], return_inverse=True)
                    head = _pack(rows[used + lo], checks[used + lo], keys[used + lo]) + _pack(*(x.astype(np.uint32) for x in (place, start[o], count[o])))
                    out[0].append(int(shard[o[0]]))
                    out[1].append(zstandard.compress(head + part[index].tobytes(), 1))
        return pa.table({"shard": pa.array(out[0], pa.int64()), "blob": pa.array(out[1], pa.binary())})

    return run


def _shard_ranges(buckets: int):
    """Step 3: (bucket, its rows, their checks and removed ranges) from one shard."""
    def run(t: pa.Table) -> pa.Table:
        blobs = [zstandard.decompress(b) for b in t.column("blob").to_pylist()]
        (row, check, key), rest = _unpack(blobs, *[np.int64] * 3)
        (place, start, count), texts = _unpack(rest, *[np.uint32] * 3)
        docs, sizes = ([struct.unpack_from("<q", b)[0] for b in bs] for bs in (blobs, rest))
        place = place.astype(np.int64) + np.repeat(np.cumsum([0, *docs[:-1]]), sizes)
        start, count = start.astype(np.int64), count.astype(np.int64)
        row, check, key = row[place], check[place], key[place]
        size = count + LENGTH - 1
        raw = b"".join(texts)
        ends = np.cumsum(size)
        ids: dict[bytes, int] = {}
        own = np.fromiter((ids.setdefault(raw[e - s:e], len(ids)) for e, s in zip(ends.tolist(), size.tolist())), np.int64, len(size))
        least = np.full(len(ids), _NO_ID, np.int64)
        np.minimum.at(least, own, key)
        t16 = np.frombuffer(b"".join(b + b"\0" for b in ids), np.uint8).astype(np.uint16) + np.uint16(1)
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        last = np.cumsum(length + 1) - 1
        t16[last] = 0
        first = last - length
        # only suffixes with a whole string in them matter; others just take part in the sorting
        order = suffix_array(t16)
        of = np.repeat(np.arange(len(ids)), length + 1)[order]
        whole = order + LENGTH <= last[of]
        order, of = order[whole], of[whole]
        same = equal_prefixes(t16, order, LENGTH)
        head = np.flatnonzero(~same)
        best = np.repeat(np.minimum.reduceat(least[of], head), np.diff(np.append(head, len(order))))
        smallest = np.zeros(len(t16), np.int64)
        smallest[order] = best
        # back to every occurrence: its strings that start in a smaller document
        rep = np.repeat(np.arange(len(key)), count)
        off = np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count)
        gone = smallest[first[own[rep]] + off] < key[rep]
        rep, off = rep[gone], off[gone]
        new = np.append(True, (rep[1:] != rep[:-1]) | (off[1:] != off[:-1] + 1)) if len(rep) else np.zeros(0, bool)
        a = np.flatnonzero(new)
        z = np.append(a[1:], len(rep)) - 1 if len(a) else a
        keys, blobs = _runs_of(row[rep[a]] % buckets, row[rep[a]], check[rep[a]], start[rep[a]] + off[a], start[rep[a]] + off[z] + LENGTH)
        return pa.table({"bucket": pa.array(keys, pa.int64()), "blob": pa.array([zstandard.compress(b, 1) for b in blobs], pa.binary())})

    return run


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.append(True, lo[1:] > hi[:-1])
    at = np.flatnonzero(new)
    return lo[at], hi[np.append(at[1:], len(lo)) - 1]


def _outcome(id_type: pa.DataType):
    """Step 4: what is left of the bucket's documents."""
    def run(t: pa.Table, ranges: pa.Table) -> pa.Table:
        buf, offs = utf8(t.column("text"))
        rows, checks, keys = (_ints(t, c) for c in ("row", "check", "key"))
        (row, check, lo, hi), _ = _unpack(map(zstandard.decompress, ranges.column("blob").to_pylist()), *[np.int64] * 4)
        order = np.argsort(row, kind="stable")
        row, check, lo, hi = row[order], check[order], lo[order], hi[order]
        begin, end = np.searchsorted(row, rows), np.searchsorted(row, rows, side="right")
        out = [], [], [], [], []
        for r in range(len(rows)):
            raw = buf[offs[r]:offs[r + 1]]
            removed, spans, kept = 0, 0, raw
            own = np.flatnonzero(check[begin[r]:end[r]] == checks[r]) + begin[r]
            if len(own):
                a, z = merged(lo[own], hi[own])
                mask = np.zeros(len(raw) + 1, np.int8)
                mask[a] += 1
                mask[z] -= 1
                gone = np.cumsum(mask[:-1]) > 0
                removed, spans, kept = int(gone.sum()), len(a), raw[~gone]
            for col, v in zip(out, (len(raw), removed, spans, hashlib.sha256(kept.tobytes()).hexdigest(), kept.tobytes())):
                col.append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        ids = pa.array(keys, pa.int64(), mask=keys == _NO_ID).cast(id_type)
        return pa.table([ids, *(pa.array(c, y) for c, y in zip(out, types))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    parts = table_parts(docs.sparkSession)
    shards = parts * SHARDS
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(key.alias("key"), text.alias("text")).select("key", "text", F.xxhash64("key", "text").alias("row"), F.xxhash64("text", "key").alias("check"))
    src = src.withColumn("bucket", F.pmod("row", F.lit(parts)))
    sent = src.groupBy("bucket").applyInArrow(_sent(parts), "part bigint, bucket bigint, blob binary")
    recur = sent.groupBy("part").applyInArrow(_recurring, "bucket bigint, blob binary")
    dealt = src.groupBy("bucket").cogroup(recur.groupBy("bucket")).applyInArrow(_dealt(shards), "shard bigint, blob binary")
    ranges = dealt.groupBy("shard").applyInArrow(_shard_ranges(parts), "bucket bigint, blob binary")
    id_type = docs.schema[id_col].dataType
    schema = f"doc_id {id_type.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return src.groupBy("bucket").cogroup(ranges.groupBy("bucket")).applyInArrow(_outcome(to_arrow_type(id_type)), schema)


def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept")
