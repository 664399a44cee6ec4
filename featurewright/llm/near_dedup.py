"""MinHash near-dedup with tensored banding.

Two small collections A and B of ``TABLES`` sub-keys, each made of ``ROWS``
minhashes, replace TABLES^2 full band keys: table (i, j) is keyed by the pair
(A_i, B_j), so 2 * TABLES * ROWS minhashes serve TABLES^2 tables.  With 16 and
3: 96 minhashes, 256 tables; a pair at similarity 0.8 shares a table with
probability (1 - (1 - 0.8^3)^16)^2 > 0.99997.

1. One pass: set size, a 128-bit set fingerprint, A and B of each document
   (checkpoint; no text).  Equal sets become one node, so copies never meet; where
   different texts share a fingerprint, a digest of the full sets tells them apart.
2. A sub-key that only one node has can form no table key.  ``SEEDS`` tables of
   each of A's sub-keys seed the components: each bucket of two or more nodes is
   a star on one of them, so edges grow with the members, not with their pairs.
   The top is the first in a random order that differs between A's sub-keys.
3. Edges whose set sizes allow the similarity are confirmed on the full word
   shingle sets; linked components come from min-labels with pointer jumping.
4. Sub-keys that still hold several components: what shares a table key, of all
   TABLES^2, across components, and only that, is compared as well, and the
   components closed.
   Where a sub-key or its most frequent component has more than ``BLOCK``
   nodes, the others there meet that component and each other block by block, on
   compact sets, all else pair by pair: at most ``BLOCK`` rows a node.  So every
   pair that shares a table is linked, already joined, or was refuted.

Null or blank text has the empty set and is linked with nothing.  Fewer words
than the shingle length make one shingle.  A null id is larger than any other;
rows that share an id are separate documents.
"""

from __future__ import annotations

import functools
import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.llm.common import LABEL_BYTES, documents, freeing, packed, row_slices, small_side, staged, utf8

WORDS, PERCENT, TABLES, ROWS, BLOCK, SEEDS = 5, 80, 16, 3, 64, 2
#: Bytes of shingle hashes in a block of a large group.
BLOCK_BYTES = 2 << 20

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_RNG.integers(0, 2**62)) * 4 + 1
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def _mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (xor-shift-multiply)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    ps = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        ps.append(np.cumprod(p, dtype=np.uint64))
    return ps[0], ps[1]


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the rows' words, A-Z lower-cased, and the rows' offsets in them."""
    n = len(buf)
    blank = np.ones(n + 1, bool)
    blank[:n] = _BLANK[buf]
    head = ~blank[:n]
    head[1:] &= blank[:n - 1]
    edge = offs[:-1][np.diff(offs) > 0]
    head[edge] = ~blank[edge]
    tail = ~blank[:n]
    tail[:-1] &= blank[1:n]
    last = offs[1:][np.diff(offs) > 0] - 1
    tail[last] = ~blank[last]
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    # a sum of mixed (byte, place in the word) values; a polynomial in 64 bits has collisions for every base
    place = np.arange(n) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [n]])))
    value = _mix(_BYTE[_LOWER[buf]] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    return _mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offs)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the rows and the rows' offsets in them."""
    w, at = word_hashes(buf, offs)
    n = max(0, len(w) - k + 1)
    h = w[:n].copy()
    for j in range(1, k):
        h = _mix(h) + w[j:j + n]
    sets, sizes = [], np.zeros(len(offs), np.int64)
    for r, (a, b) in enumerate(zip(at, at[1:])):
        if b - a >= k:
            s = np.unique(h[a:b - k + 1])
        elif b > a:  # the whole short sequence is one shingle
            s = w[a:a + 1] + np.uint64(b - a)
            for x in range(a + 1, b):
                s = _mix(s) + w[x:x + 1]
        else:
            continue
        sets.append(s)
        sizes[r + 1] = len(s)
    return _mix(np.concatenate(sets)) if sets else np.zeros(0, np.uint64), np.cumsum(sizes)


@functools.cache
def _params(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sub_keys(h: np.ndarray, at: np.ndarray, tables: int, rows: int) -> np.ndarray:
    """(row, 2 * tables) 32-bit sub-keys: the first half is collection A, the second B."""
    xor, mul = _params(2 * tables * rows)
    out = np.zeros((len(at) - 1, 2 * tables), np.int32)
    full = np.diff(at) > 0
    starts = at[:-1][full]
    if len(starts):
        for t in range(2 * tables):
            key = np.zeros(len(starts), np.uint64)
            for p in range(t * rows, (t + 1) * rows):
                key = _mix(key + np.minimum.reduceat((h ^ xor[p]) * mul[p], starts))
            out[full, t] = (key >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def shingles(text: str | None, k: int) -> set[tuple[bytes, ...]]:
    """The full shingle set, on the words themselves."""
    w = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    return set(zip(*(w[j:] for j in range(k)))) if len(w) >= k else {tuple(w)} if w else set()


def _signatures(docs: DataFrame, k: int, tables: int, rows: int) -> DataFrame:
    def run(batches):
        for b in batches:
            buf, offs = utf8(b.column(2))
            for lo, hi in row_slices(offs, 2 << 20):
                h, at = shingle_sets(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], k)
                keys = sub_keys(h, at, tables, rows)
                n = np.diff(at)
                fps = np.zeros((2, hi - lo), np.uint64)
                if len(h):
                    fps[0, n > 0] = np.add.reduceat(_mix(h), at[:-1][n > 0])
                    fps[1, n > 0] = np.bitwise_xor.reduceat(h, at[:-1][n > 0])
                half = [pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(x).ravel()), tables).cast(pa.list_(pa.int32()))
                        for x in (keys[:, :tables], keys[:, tables:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array(fps[0].view(np.int64)), pa.array(fps[1].view(np.int64)), *half],
                    ["doc_id", "text_hash", "n", "fp1", "fp2", "a", "b"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        freeing(run), f"doc_id {id_type}, text_hash bigint, n bigint, fp1 bigint, fp2 bigint, a array<int>, b array<int>"
    ).withColumn("row", F.monotonically_increasing_id())


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over ``edges`` (x, y), for nodes with an edge."""
    both = packed(edges.select("x", "y").union(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    label = packed(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.min("x")).alias("comp")))
    while True:
        own = small_side(label, LABEL_BYTES)  # small: no shuffle but that of the minimum
        near = both.join(own.select(F.col("node").alias("y"), "comp"), "y").groupBy(F.col("x").alias("n_node")).agg(F.min("comp").alias("near"))
        best = near.join(own, F.col("node") == F.col("n_node")).select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        # pointer jumping: the label's own label
        jump = own.select(F.col("node").alias("j_node"), F.col("comp").alias("j_comp"))
        new = packed(best.join(jump, F.col("comp") == F.col("j_node")).select("node", F.least("comp", "j_comp").alias("comp"), "was"))
        label = new.select("node", "comp")
        if new.filter("comp <> was").isEmpty():
            return label


def _texts(used: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``used``: the one place where texts are moved, and only those that are compared."""
    want = staged(nodes.join(used.distinct(), "node").select("node", F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash")))
    found = docs.join(small_side(want), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))
    return staged(found.select("node", "text").dropDuplicates(["node"]))


def _alike(first: set, second: set, percent: int) -> bool:
    both = len(first & second)
    return 100 * both >= percent * (len(first) + len(second) - both)


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose full shingle sets are similar enough."""
    texts = _texts(pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))), nodes, docs)

    def check(batches):
        for b in batches:
            x, y = b.column(0).to_pylist(), b.column(1).to_pylist()
            left, right = b.column(2), b.column(3)
            keep, key, first = [], None, set()
            for r in range(b.num_rows):
                if x[r] != key:
                    key, first = x[r], shingles(left[r].as_py(), k)
                if _alike(first, shingles(right[r].as_py(), k), percent):
                    keep.append(r)
            yield pa.RecordBatch.from_arrays([pa.array([v[r] for r in keep], pa.int64()) for v in (x, y)], ["x", "y"])

    lx = texts.select(F.col("node").alias("x"), F.col("text").alias("tx"))
    ly = texts.select(F.col("node").alias("y"), F.col("text").alias("ty"))
    return packed(pairs.select("x", "y").join(ly, "y").join(lx, "x").select("x", "y", "tx", "ty").mapInArrow(freeing(check), "x bigint, y bigint"))


def _sets(used: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the nodes in ``used``: the sorted 64-bit hashes of the set, as bytes."""
    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(1))
            for lo, hi in row_slices(offs, 2 << 20):
                h, at = shingle_sets(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], k)
                blobs = [np.sort(h[x:y]).tobytes() for x, y in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(blobs, pa.binary())], ["node", "shingles"])

    return staged(_texts(used, nodes, docs).mapInArrow(freeing(run), "node bigint, shingles binary"))


def _overlaps(index: tuple[np.ndarray, np.ndarray], rows: int, h: np.ndarray) -> np.ndarray:
    """How many of the hashes ``h`` each of the indexed sets holds."""
    value, owner = index
    lo, hi = np.searchsorted(value, h), np.searchsorted(value, h, side="right")
    size = hi - lo
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return np.bincount(owner[at], minlength=rows)


def _blockwise(probes: DataFrame, comp: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (x, y) of ``probes`` (node, own, major) with the members of the component ``major`` and with its other probes.

    Blocks of members and probes meet blocks of probes; a block is bounded by the
    bytes of its sets (``BLOCK_BYTES`` of sorted shingle hashes), so a set is moved
    once per opposite block, and no pair is made a row.  Within two blocks, what
    shares a table key but no component is compared by its hashes; groups that a
    link has joined there are one from then on, so the links of two blocks are
    fewer than their rows.  They are confirmed on the full sets, and only if that
    refutes one (equal hashes of different shingles) are all that pass looked at.
    """
    majors = probes.select("major").distinct()
    members = majors.join(comp, F.col("major") == F.col("comp"), "left").select(F.coalesce("node", "major").alias("node"), F.col("major").alias("own"), "major", F.lit(False).alias("probe"))
    probing = probes.withColumn("probe", F.lit(True))
    members = members.unionByName(probing)
    sets = _sets(members.select("node"), nodes, docs, k)
    signed = sets.join(nodes.select(F.col("node").alias("s_node"), "n", "a", "b"), F.col("node") == F.col("s_node")).drop("s_node")
    placed = staged(members.join(signed, "node"))
    size = F.length("shingles")
    blocks = staged(placed.groupBy(F.col("major").alias("b_major")).agg(
        F.ceil(F.sum(size) / BLOCK_BYTES).alias("m_blocks"), F.ceil(F.sum(F.when(F.col("probe"), size).otherwise(0)) / BLOCK_BYTES).alias("p_blocks")
    ))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        at = rows.join(blocks, F.col("major") == F.col("b_major")).withColumn(own[0], F.pmod(F.xxhash64("node"), F.col(own)))
        at = at.withColumn(other[0], F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop("b_major", "m_blocks", "p_blocks")
        return at.toDF(*at.columns)

    def check(every: bool):
        def run(left, right):
            out = {"x": [], "y": []}
            if not len(left) or not len(right):
                return pd.DataFrame(out, dtype="int64")
            x, y, n = left.node.to_numpy(), right.node.to_numpy(), right.n.to_numpy()
            probe, own = right.probe.to_numpy(bool), right.own.to_numpy()
            keys = {c: np.stack(right[c]) for c in ("a", "b")}
            hashes = [np.frombuffer(s, np.uint64) for s in right.shingles]
            value, owner = np.concatenate(hashes), np.repeat(np.arange(len(y)), n)
            order = np.argsort(value)
            index = value[order], owner[order]
            group = own.copy()  # what the links found here join is not compared again
            joined = {}
            for r in range(len(x)):
                mine, its = left.n.iat[r], left.own.iat[r]
                while its in joined:
                    its = joined[its]
                live = (100 * np.minimum(n, mine) >= percent * np.maximum(n, mine)) & (own != left.own.iat[r]) & (~probe | (y > x[r]))
                if not every:
                    live &= group != its
                for c in ("a", "b"):
                    if live.any():
                        live &= (keys[c] == left[c].iat[r]).any(axis=1)
                if live.any():
                    both = _overlaps(index, len(y), np.frombuffer(left.shingles.iat[r], np.uint64))
                    at = np.flatnonzero(live & (100 * both >= percent * (n + mine - both)))
                    if not every:
                        at = at[np.unique(group[at], return_index=True)[1]]  # one link to each group
                        for g in group[at].tolist():
                            joined[g] = its
                        group[np.isin(group, group[at])] = its
                    out["x"] += [x[r]] * len(at)
                    out["y"] += y[at].tolist()
            return pd.DataFrame(out, dtype="int64")

        return run

    key = ["major", "m", "p"]
    left, right = dealt(placed.filter("probe"), "p_blocks", "m_blocks"), dealt(placed, "m_blocks", "p_blocks")

    def passing(every: bool) -> DataFrame:
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(check(every), "x bigint, y bigint")
        return staged(found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())

    found = passing(False)
    links = _confirmed(found, nodes, docs, k, percent)
    return links if found.count() == links.count() else _confirmed(passing(True), nodes, docs, k, percent)


def _minors(halves: DataFrame, comp: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of A sub-keys that hold several components, with the sub-key's most frequent one (``major``), and those of
    them outside it; ``large`` if the sub-key or that component has more than ``BLOCK`` nodes."""
    key = ["i", "ka"]
    placed = staged(halves.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    counts = placed.groupBy(*key, "comp").agg(F.count(F.lit(1)).alias("many"))
    mixed = counts.groupBy(*key).agg(F.max(F.struct("many", "comp"))["comp"].alias("major"), F.count(F.lit(1)).alias("comps"), F.sum("many").alias("held")).filter("comps > 1").drop("comps")
    mixed = mixed.join(sizes, F.col("major") == F.col("z_comp"), "left").select(*key, "major", (F.greatest("held", F.coalesce("z_n", F.lit(1))) > BLOCK).alias("large"))
    rows = staged(placed.join(mixed, key))
    return rows, rows.filter("comp <> major")


def _across(rows: DataFrame, minor: DataFrame) -> DataFrame:
    """Pairs (x, y) that share a table key but no component, each pair once, where the sub-key is not large."""
    x = minor.filter("NOT large").select("i", "ka", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("comp").alias("cx"), F.col("a").alias("ax"), F.col("b").alias("bx"))
    y = rows.filter("NOT large").select(
        F.col("i").alias("yi"), F.col("ka").alias("yka"), F.col("node").alias("y"), F.col("n").alias("ny"), F.col("comp").alias("cy"), F.col("a").alias("ay"), F.col("b").alias("by"), "major"
    )
    # the same pair may have its first sub-key in a large one: there it is compared block by block
    first_shared = F.array_position(F.zip_with("ax", "ay", lambda p, q: p == q), True) == F.col("i") + 1
    shares_b = F.exists(F.zip_with("bx", "by", lambda p, q: p == q), lambda same: same)
    apart = (F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("major")) | (F.col("cx") < F.col("cy")))
    return x.join(y, (F.col("i") == F.col("yi")) & (F.col("ka") == F.col("yka")) & apart & first_shared & shares_b)


def _verified(some: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``some`` with ``digest``: of a fingerprint that different texts share, the SHA-256 of the sorted full shingles.

    Equal fingerprints alone make no set equal.  Only one row of each text under
    such a fingerprint is read again; rows of one text need no comparison.
    """
    same = ["n", "fp1", "fp2"]
    texts = some.groupBy(*same, "text_hash").agg(F.min("row").alias("node"))
    several = texts.groupBy(*same).agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").drop("texts")
    asked = staged(texts.join(several, same))
    if asked.isEmpty():
        return some.withColumn("digest", F.lit(""))

    def run(batches):
        for batch in batches:
            digests = []
            for text in batch.column(1).to_pylist():
                h = hashlib.sha256()
                for words in sorted(shingles(text, k)):
                    h.update(b"\n".join(words) + b"\n\n")  # words hold no line ends
                digests.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], ["node", "digest"])

    found = _texts(asked.select("node"), some.withColumnRenamed("row", "node"), docs).mapInArrow(freeing(run), "node bigint, digest string")
    digests = staged(asked.join(found, "node").select(*(F.col(c).alias(f"d_{c}") for c in [*same, "text_hash"]), "digest"))
    on = reduce(lambda p, q: p & q, (F.col(c) == F.col(f"d_{c}") for c in [*same, "text_hash"]))
    return some.join(small_side(digests), on, "left").withColumn("digest", F.coalesce("digest", F.lit(""))).drop(*(f"d_{c}" for c in [*same, "text_hash"]))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS, percent: int = PERCENT, tables: int = TABLES, rows: int = ROWS,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, text_hash."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.col(text_col).alias("text"))
    # without texts: what follows needs few tasks, and each task of each stage costs the driver memory
    sigs = packed(_signatures(src, words, tables, rows))
    some = packed(_verified(sigs.filter("n > 0"), src, words))
    same_set = ["n", "fp1", "fp2", "digest"]
    sets = packed(some.groupBy(*same_set).agg(F.min("row").alias("node")))
    nodes = some.join(sets.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")

    a = nodes.select("node", "n", F.posexplode("a").alias("i", "ka"))
    shared = a.groupBy("i", "ka").agg(F.count(F.lit(1)).alias("many")).filter("many > 1").drop("many")
    halves = staged(a.join(shared, ["i", "ka"]).join(nodes.select("node", "a", "b"), "node"))
    seeds = F.array(*(F.get("b", (F.col("i") + s) % tables) for s in range(min(SEEDS, tables))))
    keyed = halves.select("node", "n", "i", "ka", F.posexplode(seeds).alias("j", "kb"))
    key = ["i", "ka", "j", "kb"]
    # another random order for each of A's sub-keys, so a document meets many tops of a large group
    top = F.min(F.struct(F.xxhash64("node", "i").alias("order"), "node", "n")).alias("top")
    stars = keyed.groupBy(*key).agg(top, F.count(F.lit(1)).alias("many")).filter("many > 1").drop("many")
    fits = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    pair = [F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")]
    tried = staged(
        keyed.join(stars, key).filter("node <> top.node")
        .select(F.col("top.node").alias("x"), F.col("node").alias("y"), F.col("top.n").alias("nx"), F.col("n").alias("ny"))
        .filter(fits).select(*pair).distinct()
    )
    links = _confirmed(tried, nodes, src, words, percent)
    comp = components(links)
    sizes = packed(comp.groupBy(F.col("comp").alias("z_comp")).agg(F.count(F.lit(1)).alias("z_n")))
    mixed, minor = _minors(halves, comp, sizes)
    pairs = _across(mixed, minor).filter(fits).select(*pair).distinct()  # a minor of one sub-key may be the major of another
    open_pairs = staged(pairs.join(tried, ["x", "y"], "left_anti"))
    probes = staged(minor.filter("large").select("node", F.col("comp").alias("own"), "major").distinct())
    more = []
    if not open_pairs.isEmpty():
        more.append(_confirmed(open_pairs, nodes, src, words, percent))
    if not probes.isEmpty():
        more.append(_blockwise(probes, comp, nodes, src, words, percent))
    found = [m for m in more if not m.isEmpty()]
    if found:
        comp = components(reduce(DataFrame.union, found, links))

    node_of = sets.select(*(F.col(c).alias(f"s_{c}") for c in same_set), "node")
    on_set = reduce(lambda p, q: p & q, (F.col(c) == F.col(f"s_{c}") for c in same_set))
    group_of = node_of.join(comp, "node", "left").withColumn("grp", F.coalesce("comp", "node")).drop("node", "comp")
    empty = sigs.filter("n = 0").withColumn("digest", F.lit(""))
    placed_rows = staged(
        some.unionByName(empty).select("doc_id", "text_hash", "row", *same_set).join(group_of, on_set, "left")
        .select("doc_id", "text_hash", "n", "row", F.coalesce("grp", "row").alias("grp"))
    )
    first = placed_rows.groupBy(F.col("grp").alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
    return placed_rows.join(first, F.col("grp") == F.col("g")).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"),
        (F.col("first.row") == F.col("row")).alias("kept"), "text_hash",
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each near-duplicate group."""
    rows = staged(near_groups(docs, id_col, text_col, **how))
    gone = staged(rows.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows")))
    drop = staged(gone.filter("NOT stays").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    out = docs.join(small_side(drop), F.col(id_col).eqNullSafe(F.col("__id")) & (text_hash == F.col("__hash")), "left_anti")
    if gone.filter("stays AND rows > 1").isEmpty():
        return out
    return out.withColumn("__hash", text_hash).dropDuplicates([id_col, "__hash"]).drop("__hash")  # repeated rows of one document


def op3_minhash_tensored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), words=2).drop("text_hash")
