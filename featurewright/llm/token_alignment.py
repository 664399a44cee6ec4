"""Cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes; offsets at which tokens of both end cut a
text into groups, and every token of one side is linked with every token of the
other side in its group.  A pair's count is the number of documents that hold it.

1. One pass over the texts.  Documents come in slabs of about ``SLAB`` characters.
   A slab's records (pair, document, links) are sorted side-major (A id, then B
   id) and radix-partitioned by A id: each radix is one run of zstd blocks.  Runs
   and document rows are written to the shared folder once.
2. Runs are dealt by (radix, salt).  A radix has as many salts as its bytes need
   at ``GROUP_BYTES`` each, so an A id that every document holds is spread over
   many tasks.  In a group a k-way heap merge over the runs' blocks counts each
   pair; counts of the salts are summed by pair.
3. The same groups meet the counts of their radix, in side-major order: one sweep
   gives each A id's maximum, and run after run is streamed against it.  A run
   gives back two numbers per document of its slab, which are summed by slab.

Memory: a slab's records; in a group the compressed runs, one open block a run and
the counts of one radix (at most A ids / ``RADICES`` times B ids, whatever the
input).  No record is ever a row, so shuffles carry compressed blocks only.

Null and empty texts, and texts whose tokens do not spell them (such as U+2581,
which B writes for a space), have no tokens: zeros, an empty digest.  Rows that
share an id, or have none, are documents of their own.  Other columns are not
read.  An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.llm.common import documents, freeing, table

SIDE_A, SIDE_A_RANKS, SIDE_B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
RADICES, SLAB, SLICE, BLOCK, GROUP_BYTES = 64, 8 << 20, 1 << 19, 1 << 15, 32 << 20
#: Bits of an A id, of a B id, and of a document's number in its slab.
A_BITS, B_BITS, D_BITS = 19, 19, 18
_RADIX_BITS = RADICES.bit_length() - 1
_LONG_SPACE = re.compile(r"\s{5000}")


# --- the two sides -----------------------------------------------------------


class Sides:
    """Token ids of both sides for one text, and the bytes each id stands for."""

    def __init__(self, a: str = SIDE_A, a_ranks: str = SIDE_A_RANKS, b: str = SIDE_B):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        from featurewright.llm.byte_bpe import read_ranks

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_file(public_tokenizers.path(a))
        self.exact.encode_special_tokens = True
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(a_ranks), special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        alphabet = _byte_alphabet()
        self.a_bytes = [b""] * self.exact.get_vocab_size()
        for token, i in self.exact.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if alphabet.keys() >= set(token) else token.encode()
        p = self.pieces
        self.b_bytes = [bytes([int(p.id_to_piece(i)[3:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode() for i in range(p.get_piece_size())]
        if len(self.a_bytes) > 1 << A_BITS or len(self.b_bytes) > 1 << B_BITS:
            raise ValueError("a vocabulary is larger than the record format allows")
        self.a_len = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_len = np.array(list(map(len, self.b_bytes)), np.int64)

    def ids_a(self, text: str) -> np.ndarray:
        """The JSON tokenizer's ids; in Latin-1 its rank file gives the same ids, faster."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)
        if len(text) >= 5000 and _LONG_SPACE.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def both(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None where there are no tokens."""
        if not text:
            return None
        spelled = (" " + text).encode()
        b = self.pieces.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != spelled:
            return None
        a = self.ids_a(" " + text)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != spelled:
            return None
        return a, np.array(b, np.int64)


def _byte_alphabet() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def _sides(a: str, a_ranks: str, b: str) -> Sides:
    return Sides(a, a_ranks, b)


# --- groups and records of a slice -------------------------------------------


class Aligned:
    """Groups of a few documents' tokens; documents lie one after another."""

    def __init__(self, sides: Sides, pairs: list[tuple[np.ndarray, np.ndarray]]):
        self.a = np.concatenate([p[0] for p in pairs])
        self.b = np.concatenate([p[1] for p in pairs])
        self.n_a = np.array([len(p[0]) for p in pairs], np.int64)
        self.n_b = np.array([len(p[1]) for p in pairs], np.int64)
        end_a, end_b = np.cumsum(sides.a_len[self.a]), np.cumsum(sides.b_len[self.b])
        ends = np.zeros(int(end_a[-1]) + 1, np.uint8)
        ends[end_a] = 1
        ends[end_b] += 2
        shared = ends == 3
        before = np.cumsum(shared) - shared  # common ends before each offset
        self.group_a, self.group_b = before[end_a], before[end_b]
        self.groups = int(shared.sum())
        self.size_a = np.bincount(self.group_a, minlength=self.groups)
        self.size_b = np.bincount(self.group_b, minlength=self.groups)
        doc_end = end_a[np.cumsum(self.n_a) - 1]
        self.doc = np.searchsorted(doc_end, np.flatnonzero(shared))  # of each group
        self.n_groups = np.bincount(self.doc, minlength=len(pairs))
        first = np.cumsum(self.n_groups) - self.n_groups
        self.n_links = np.add.reduceat(self.size_a * self.size_b, first)

    def digests(self, strings: list[str]) -> list[str]:
        """SHA-256 per document of its groups in decimal; ``strings`` has each id followed by a comma, a bar, a semicolon."""
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)
        b_before = np.cumsum(self.size_b) - self.size_b
        a_through = np.cumsum(self.size_a)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + b_before[self.group_a]] = self.a * 3 + last_a
        code[np.arange(len(self.b)) + a_through[self.group_b]] = self.b * 3 + 2 * last_b
        out, lo = [], 0
        for n in (self.n_a + self.n_b).tolist():
            h = hashlib.sha256()
            for at in range(lo, lo + n, 1 << 20):
                hi = min(at + (1 << 20), lo + n)
                part = "".join(map(strings.__getitem__, code[at:hi].tolist()))
                h.update((part[:-1] if hi == lo + n else part).encode())
            out.append(h.hexdigest())
            lo += n
        return out

    def records(self, first_doc: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (A id with its radix in front, B id, document) and their numbers of links."""
        a, b, ga, gb = self.a, self.b, self.group_a, self.group_b
        wa, wb = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
        if int((self.size_a * self.size_b).max()) > 4096:  # equal ids of a group count once, with a weight
            ga, a, wa = _weighted(ga, a, A_BITS)
            gb, b, wb = _weighted(gb, b, B_BITS)
        size_b = np.bincount(gb, minlength=self.groups)
        start_b = np.cumsum(size_b) - size_b
        times = size_b[ga]
        through = np.cumsum(times)
        doc = self.doc + first_doc
        keys, links, lo = [], [], 0
        while lo < len(a):  # at most about 2 M pairs at once
            done = int(through[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(through, done + (1 << 21), side="right")))
            t = times[lo:hi]
            of_a = np.repeat(np.arange(lo, hi), t)
            within = np.arange(len(of_a)) - np.repeat(through[lo:hi] - t - done, t)
            of_b = start_b[ga[of_a]] + within
            keys.append(_turned(a[of_a]) << (B_BITS + D_BITS) | b[of_b] << D_BITS | doc[ga[of_a]])
            links.append(wa[of_a] * wb[of_b])
            if hi < len(a) or len(keys) > 1:
                keys[-1], links[-1] = _summed(keys[-1], links[-1])
            lo = hi
        return _summed(np.concatenate(keys), np.concatenate(links))


def _weighted(group: np.ndarray, ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, n = np.unique(group << bits | ids, return_counts=True)
    return key >> bits, key & (1 << bits) - 1, n


def _turned(a: np.ndarray) -> np.ndarray:
    """A ids with their radix (the low bits) in front, so that sorted records of a radix lie together."""
    return (a & RADICES - 1) << (A_BITS - _RADIX_BITS) | a >> _RADIX_BITS


def _summed(keys: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, links = keys[order], links[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(links, first) if len(first) else links


# --- runs ---------------------------------------------------------------------


def write_run(keys: np.ndarray, links: np.ndarray) -> bytes:
    """Sorted records as zstd blocks; a pair lies in one block."""
    if not len(keys):
        return b""
    pair, doc = keys >> D_BITS, (keys & (1 << D_BITS) - 1).astype(np.uint32)
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    ends = np.append(first[1:], len(keys))
    out, lo, packer = [], 0, zstandard.ZstdCompressor(level=1)
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(ends, first[lo] + BLOCK, side="right")))
        r = slice(int(first[lo]), int(ends[hi - 1]))
        n = (ends[lo:hi] - first[lo:hi]).astype(np.uint32)
        body = struct.pack("<II", hi - lo, r.stop - r.start) + pair[first[lo:hi]].tobytes() + n.tobytes() + doc[r].tobytes() + links[r].tobytes()
        packed = packer.compress(body)
        out += [struct.pack("<I", len(packed)), packed]
        lo = hi
    return b"".join(out)


def read_run(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: pairs, documents per pair, and the records' documents and links."""
    at, unpacker = 0, zstandard.ZstdDecompressor()
    while at < len(run):
        (size,) = struct.unpack_from("<I", run, at)
        body = unpacker.decompress(run[at + 4:at + 4 + size])
        at += 4 + size
        p, n = struct.unpack_from("<II", body)
        cuts = np.cumsum([8, 8 * p, 4 * p, 4 * n])
        yield (np.frombuffer(body, np.int64, p, cuts[0]), np.frombuffer(body, np.uint32, p, cuts[1]),
               np.frombuffer(body, np.uint32, n, cuts[2]), np.frombuffer(body, np.int64, n, cuts[3]))


def merge_counts(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way heap merge: pairs in order, each with the number of records that all runs hold.

    The heap orders the runs by the first pair of their open block.  What is not
    above the smallest end of an open block can't be met again later and goes out.
    """
    readers = [read_run(r) for r in runs]
    open_: dict[int, list[np.ndarray]] = {}
    heads: list[tuple[int, int]] = []
    ends: list[tuple[int, int]] = []

    def advance(k: int) -> None:
        block = next(readers[k], None)
        if block is not None:
            open_[k] = [block[0], block[1].astype(np.int64)]
            heapq.heappush(heads, (int(block[0][0]), k))
            heapq.heappush(ends, (int(block[0][-1]), k))

    for k in range(len(runs)):
        advance(k)
    while heads:
        limit = ends[0][0]
        pairs, counts = [], []
        while heads and heads[0][0] <= limit:
            _, k = heapq.heappop(heads)
            p, n = open_[k]
            cut = int(np.searchsorted(p, limit, side="right"))
            pairs.append(p[:cut])
            counts.append(n[:cut])
            if cut < len(p):
                open_[k] = [p[cut:], n[cut:]]
                heapq.heappush(heads, (int(p[cut]), k))
            else:
                del open_[k]
        while ends and ends[0][0] <= limit:
            advance(heapq.heappop(ends)[1])
        yield _summed(np.concatenate(pairs), np.concatenate(counts))


# --- the three stages -----------------------------------------------------------

_DOC = ["n_a", "n_b", "n_groups", "n_links"]


def _spill(names: tuple[str, str, str]):
    """mapInArrow: document rows (radix null) and runs (idx null) of slabs."""
    schema_of = ["slab", "idx", "doc_id", *_DOC, "groups_sha256", "radix", "run"]

    def run(batches):
        sides = _sides(*names)
        strings = [f"{i}{sep}" for i in range(max(len(sides.a_bytes), len(sides.b_bytes))) for sep in ",|;"]
        part, number = TaskContext.get().partitionId(), 0
        docs: list[list] = []
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[tuple[int, tuple]] = []
        slab_chars = slice_chars = 0

        def align() -> None:
            if waiting:
                found = Aligned(sides, [p for _, p in waiting])
                digests = found.digests(strings)
                for k, (d, _) in enumerate(waiting):
                    docs[d][1:] = [int(found.n_a[k]), int(found.n_b[k]), int(found.n_groups[k]), int(found.n_links[k]), digests[k]]
                keys, links = found.records(0)
                numbers = np.array([d for d, _ in waiting], np.int64)
                mask = (1 << D_BITS) - 1
                keys = keys & ~mask | numbers[keys & mask]  # numbers rise, so the order stays
                kept.append((keys, links))
                waiting.clear()

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            align()
            slab = (part << 32) + number
            number += 1
            n = len(docs)
            columns = list(zip(*docs))
            yield pa.RecordBatch.from_arrays(
                [pa.array([slab] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(columns[0], id_type[0]),
                 *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(columns[5], pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                schema_of)
            docs.clear()
            if kept:
                keys, links = np.concatenate([k for k, _ in kept]), np.concatenate([x for _, x in kept])
                kept.clear()
                order = np.argsort(keys)
                keys, links = keys[order], links[order]
                cuts = np.searchsorted(keys, np.arange(RADICES + 1) << (A_BITS - _RADIX_BITS + B_BITS + D_BITS))
                for r in range(RADICES):
                    lo, hi = cuts[r], cuts[r + 1]
                    if lo < hi:
                        blob = write_run(keys[lo:hi], links[lo:hi])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([slab], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, id_type[0]), *(pa.nulls(1, pa.int64()) for _ in _DOC),
                             pa.nulls(1, pa.string()), pa.array([r], pa.int32()), pa.array([blob], pa.binary())], schema_of)

        id_type: list[pa.DataType] = []
        for batch in batches:
            id_type[:] = [batch.column(0).type]
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    found = sides.both(text)
                    docs.append([doc_id, 0, 0, 0, 0, ""])
                    if found is not None:
                        waiting.append((len(docs) - 1, found))
                        slab_chars += len(text)
                        slice_chars += len(text)
                    if slice_chars >= SLICE:
                        align()
                        slice_chars = 0
                    if slab_chars >= SLAB or len(docs) == 1 << D_BITS:
                        yield from close()
                        slab_chars = slice_chars = 0
        if docs:
            yield from close()

    return run


def _count(runs: pa.Table) -> pa.Table:
    """(pair, n) of one group of runs."""
    found = list(merge_counts(runs.column("run").to_pylist()))
    pairs = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
    n = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
    return pa.table({"radix": pa.array(np.full(len(pairs), runs.column("radix")[0].as_py() if runs.num_rows else 0, np.int32)), "pair": pairs, "n": n})


def _give_back(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """Per run: its slab, and per document of it the links of highest count and the sum of counts."""
    pair, n = counts.column("pair").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    side = pair >> B_BITS
    first = np.flatnonzero(np.append(True, side[1:] != side[:-1])) if len(side) else np.zeros(0, np.int64)
    highest = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(n)))) if len(first) else n
    best = n == highest
    slabs, blobs, packer = [], [], zstandard.ZstdCompressor(level=1)
    for k in range(runs.num_rows):
        sums = np.zeros((2, 1 << D_BITS), np.int64)
        size = 0
        for p, per, doc, links in read_run(runs.column("run")[k].as_py()):
            at = np.repeat(np.searchsorted(pair, p), per)
            np.add.at(sums[0], doc, links * best[at])
            np.add.at(sums[1], doc, links * n[at])
            size = max(size, int(doc.max()) + 1)
        slabs.append(runs.column("slab")[k].as_py())
        blobs.append(packer.compress(np.ascontiguousarray(sums[:, :size]).tobytes()))
    return pa.table({"slab": pa.array(slabs, pa.int64()), "back": pa.array(blobs, pa.binary())})


def _finish(docs: pa.Table, back: pa.Table) -> pa.Table:
    idx = docs.column("idx").to_numpy()
    sums = np.zeros((2, int(idx.max(initial=-1)) + 1), np.int64)
    unpacker = zstandard.ZstdDecompressor()
    for blob in back.column("back").to_pylist():
        part = np.frombuffer(unpacker.decompress(blob), np.int64).reshape(2, -1)
        sums[:, :part.shape[1]] += part
    out = docs.select(["doc_id", *_DOC])
    out = out.append_column("n_best", pa.array(sums[0][idx])).append_column("count_sum", pa.array(sums[1][idx]))
    return out.append_column("groups_sha256", docs.column("groups_sha256"))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = SIDE_A, a_ranks: str = SIDE_A_RANKS, b: str = SIDE_B) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return _aligned(_spilled(docs, id_col, text_col, a, a_ranks, b))


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = SIDE_A, a_ranks: str = SIDE_A_RANKS, b: str = SIDE_B) -> DataFrame:
    """The alignment table itself: a, b (ids), n (documents that hold the pair linked), best (no pair of this A id has more)."""
    spilled = _spilled(docs, id_col, text_col, a, a_ranks, b)
    counts = _totals(_dealt(spilled)[0])
    turned = F.shiftright("pair", B_BITS)
    low = A_BITS - _RADIX_BITS
    ids = counts.select(
        (F.shiftleft(turned.bitwiseAND((1 << low) - 1), _RADIX_BITS).bitwiseOR(F.shiftright(turned, low))).alias("a"),
        F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b"), "n")
    highest = ids.groupBy("a").agg(F.max("n").alias("highest"))
    return ids.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def _spilled(docs: DataFrame, id_col: str, text_col: str, a: str, a_ranks: str, b: str) -> DataFrame:
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = f"slab bigint, idx int, doc_id {id_type}, {', '.join(c + ' bigint' for c in _DOC)}, groups_sha256 string, radix int, run binary"
    return table(src.mapInArrow(freeing(_spill((a, a_ranks, b))), schema), "alignment")


def _dealt(spilled: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The runs with their salt, and the number of salts of each radix (at most ``RADICES`` rows are collected)."""
    runs = spilled.where("radix IS NOT NULL").select("slab", "radix", "run")
    sizes = runs.groupBy("radix").agg(F.sum(F.length("run")).alias("bytes")).collect()
    salts = {r["radix"]: math.ceil(r["bytes"] / GROUP_BYTES) for r in sizes}
    of_radix = _salts(salts)
    return runs.withColumn("salt", F.pmod(F.xxhash64("slab"), of_radix).cast("int")), salts


def _salts(salts: dict[int, int]):
    if not salts:
        return F.lit(1)
    return F.element_at(F.create_map(*[F.lit(x) for kv in salts.items() for x in kv]), F.col("radix"))


def _totals(runs: DataFrame) -> DataFrame:
    partial = runs.groupBy("radix", "salt").applyInArrow(_count, "radix int, pair bigint, n bigint")
    return partial.groupBy("radix", "pair").agg(F.sum("n").alias("n"))


def _aligned(spilled: DataFrame) -> DataFrame:
    runs, salts = _dealt(spilled)
    counts = _totals(runs).withColumn("salt", F.explode(F.sequence(F.lit(0), _salts(salts).cast("int") - 1)))
    key = ("radix", "salt")
    back = runs.groupBy(*key).cogroup(counts.groupBy(*key)).applyInArrow(_give_back, "slab bigint, back binary")
    rows = spilled.where("radix IS NULL").drop("radix", "run")
    id_type = spilled.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {', '.join(c + ' bigint' for c in _DOC)}, n_best bigint, count_sum bigint, groups_sha256 string"
    return rows.groupBy("slab").cogroup(back.groupBy("slab")).applyInArrow(_finish, schema)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(documents(spark, sf_dir))
